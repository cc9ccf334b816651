"""Time conversions that do not depend on the session time zone.

The ad stream carries epoch milliseconds; we turn them into a wall-clock
``timestamp_ntz`` in an explicit zone (default UTC), so day and minute keys
are the same on every executor and in every session.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_millis_of_ntz(ts: Column) -> Column:
    """Milliseconds since 1970-01-01 of a wall-clock timestamp read as UTC."""
    return F.timestamp_diff("MILLISECOND", _epoch_ntz(), ts.cast("timestamp_ntz"))


def ntz_of_epoch_millis(ms: Column, tz: str = "UTC") -> Column:
    """Wall-clock time in ``tz`` of an epoch-millisecond instant (``timestamp_ntz``)."""
    utc = F.timestamp_add("MILLISECOND", ms, _epoch_ntz())
    if tz.upper() in ("UTC", "Z", "+00:00", "GMT"):
        return utc
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def utc_wallclock(df_schema, column: str) -> Column:
    """``column`` as a UTC wall-clock ``timestamp_ntz`` whatever type the reader gave it.

    Parquet timestamps without a zone read as ``timestamp_ntz``; if a session reads them
    as zoned instants instead, convert through epoch microseconds, never the session zone.
    """
    from pyspark.sql import types as T

    dtype = df_schema[column].dataType
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_add("MICROSECOND", F.unix_micros(F.col(column)), _epoch_ntz())
    return F.col(column).cast("timestamp_ntz")


def day_key(ts: Column) -> Column:
    """``yyyy-MM-dd`` of a wall-clock timestamp."""
    return F.date_format(ts, "yyyy-MM-dd")


def minute_start(ts: Column) -> Column:
    """Timestamp truncated to the minute (the grouping key; keeps the date)."""
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def minute_label(ts: Column) -> Column:
    """``HH:mm`` label used in the trend JSON."""
    return F.date_format(ts, "HH:mm")


def minute_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm`` text of a minute key."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm")
