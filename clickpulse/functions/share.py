"""Per-city click share text: ``name:pct%,name:pct%,OTHER:pct%``.

Rules (fixed to match the reference output):
- the two cities with most clicks are shown, ties broken by city name;
- each share is rounded half-up to one decimal: ``floor(n * 1000 / total + 0.5) / 10``;
- the "other" label is always appended with ``100 - shown shares`` rounded the same way
  (so it may be ``0.0`` or even ``-0.1`` when both shown shares round up);
- items are joined by ``,``; a share prints as its double text (``50.0``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickpulse.constants import OTHER_LABEL  # fixed value, see constants.py


def round_half_up_1(x: Column) -> Column:
    """Java ``Math.round(x * 10) / 10D`` for a double ``x``."""
    return F.floor(x * F.lit(10.0) + F.lit(0.5)) / F.lit(10.0)


def pct_1(n: Column, total: Column) -> Column:
    """``Math.round(n * 1000 / total) / 10D`` -> percentage with one decimal."""
    return F.floor(n.cast("double") * F.lit(1000.0) / total + F.lit(0.5)) / F.lit(10.0)


def share_text(top: Column, total: Column, other_label: str = OTHER_LABEL) -> Column:
    """Build the share string from ``top`` = array<struct<city_name, n>> (already ordered, <= 2)."""
    shown = F.transform(top, lambda x: F.struct(x["city_name"].alias("city_name"), pct_1(x["n"], total).alias("p")))
    rest = F.aggregate(shown, F.lit(100.0), lambda acc, x: acc - x["p"])
    items = F.concat(
        F.transform(shown, lambda x: F.concat(x["city_name"], F.lit(":"), x["p"].cast("string"), F.lit("%"))),
        F.array(F.concat(F.lit(other_label), F.lit(":"), round_half_up_1(rest).cast("string"), F.lit("%"))),
    )
    return F.array_join(items, ",")
