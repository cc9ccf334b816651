"""Cuts of long sessions by a quantile sketch.

A window over a session puts the whole session into one task. Here one pass sketches the quantiles
(KLL) of an order-keeping number, 32 bits of the session's hash above its time in seconds. A session
that holds more than a share of all rows contains some of the quantiles, and those are kept as data,
a small table of cut times per hash. The slice of a row is then a pure function of the row: how many
of its session's cuts are not after it. Nothing is written, and no session that contains no cut is
touched at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH = "_session_hash"
CUTS = "_cuts"
SLICE = "_slice"
CUT_SCHEMA = T.StructType([T.StructField(HASH, T.IntegerType()), T.StructField(CUTS, T.ArrayType(T.LongType()))])


def session_hash(session: Column) -> Column:
    """32 bits of a session's hash; rows without a session share one."""
    return F.shiftright(F.xxhash64(session.cast("string")), 32).cast("int")


def second_of(df: DataFrame, column: str) -> Column:
    """Order-keeping seconds of a time column in 32 unsigned bits (nulls first, years outside 1970 to 2106 at the ends).

    Columns of other types give 0, so their sessions are never cut.
    """
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, T.TimestampNTZType):
        seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    elif isinstance(kind, T.TimestampType):
        seconds = F.unix_seconds(c)
    elif isinstance(kind, T.DateType):
        seconds = F.unix_date(c).cast("long") * 86_400
    else:
        return F.lit(0).cast("long")
    return F.least(F.greatest(F.coalesce(seconds, F.lit(0)), F.lit(0)), F.lit((1 << 32) - 1)).cast("long")


def sketch_size(slices: int) -> int:
    """Sketch parameter whose rank error is well under one slice."""
    return max(200, min(65_535, 8 * slices))


def session_cuts(rows: DataFrame, session: str, time: str, slices: int) -> list[tuple[int, list[int]]]:
    """At most ``slices`` - 1 quantiles of (hash of the session, second), as (hash, sorted cut seconds); one job."""
    if slices < 2:
        return []
    key = F.shiftleft(session_hash(F.col(session)).cast("long"), 32).bitwiseOR(second_of(rows, time))
    ranks = F.array(*[F.lit(i / slices) for i in range(1, slices)]) if slices <= 512 else F.transform(
        F.sequence(F.lit(1), F.lit(slices - 1)), lambda i: i / F.lit(float(slices)))
    sketch = rows.agg(F.kll_sketch_agg_bigint(key, F.lit(sketch_size(slices))).alias("s"))
    found = sketch.select(F.when(F.kll_sketch_get_n_bigint("s") > 0, F.kll_sketch_get_quantile_bigint("s", ranks)).alias("q")).first()[0]
    cuts: dict[int, set[int]] = {}
    for q in found or ():
        cuts.setdefault(q >> 32, set()).add(q & 0xFFFFFFFF)
    return [(h, sorted(seconds)) for h, seconds in sorted(cuts.items())]


def not_after(cuts: Column, second: Column, longest: int) -> Column:
    """How many of the sorted ``cuts`` (null: none; at most ``longest``) are not after ``second``: a binary search."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, longest).bit_length()))])
    there = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.coalesce(F.get(cuts, at + step - 1) <= second, F.lit(False)), at + step).otherwise(at))
    return F.when(cuts.isNull(), F.lit(0)).otherwise(there)


def with_slices(rows: DataFrame, session: str, time: str, cuts: list[tuple[int, list[int]]], only_cut: bool = False) -> DataFrame:
    """``rows`` with the slice of each in its session (0 if the session has no cuts); ``only_cut``: rows of cut sessions only.

    The table of cuts has fewer rows than there are slices, so it is broadcast.
    """
    table = rows.sparkSession.createDataFrame(cuts, CUT_SCHEMA)
    hashed = rows.withColumn(HASH, session_hash(F.col(session)))
    joined = hashed.join(F.broadcast(table), HASH, "inner" if only_cut else "left")
    longest = max((len(c) for _, c in cuts), default=0)
    return joined.withColumn(SLICE, not_after(F.col(CUTS), second_of(rows, time), longest)).drop(HASH, CUTS)
