"""Lists of (key, count) as JSON text: ``[{"3":120},{"1":98}]``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pairs_json(items: Column, key: str = "k", value: str = "n") -> Column:
    """``items`` = ordered array<struct<key, value>> -> JSON array of one-field objects."""
    return F.to_json(F.transform(items, lambda x: F.create_map(x[key].cast("string"), x[value])))

