"""Comma-joined id lists as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_ids(ids: Column, sep: str = ",") -> Column:
    """Split an id list, dropping empty items (``"1,,2"``, ``"1,2,"`` and ``""`` give only real ids).

    Java's split drops trailing empties and Spark's keeps them, so empties are
    filtered explicitly. A null list gives null (no rows after ``explode``).
    """
    return F.filter(F.split(ids, sep), lambda x: F.length(F.trim(x)) > 0)


def adjacent_pairs(items: list[str], sep: str = "-") -> list[str]:
    """``["1","2","3"]`` -> ``["1-2","2-3"]`` (parameter lists only, never data)."""
    return [f"{a}{sep}{b}" for a, b in zip(items, items[1:])]
