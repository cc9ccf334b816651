"""Join helpers: broadcast only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse import storage
from clickpulse.session import scratch_dir

# Rows a broadcast side may hold when its size is only known at run time.
DEFAULT_BROADCAST_ROWS = 2_000_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most ``max_rows + 1``)."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Hint ``broadcast`` when the side is checked small; otherwise leave it to a shuffle join.

    Use for sides whose size is data-dependent (e.g. the blocked-user set). Sides
    that are bounded by construction (a top-10 list) can use ``F.broadcast`` directly.
    """
    if row_count_at_most(df, max_rows):
        return F.broadcast(df)
    return df


# Bytes on disk a written side may have to be broadcast (columnar files; a few times that in memory).
BROADCAST_BYTES = 64 << 20


def written_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the session's shared checkpoint folder and read it back.

    Lineage is cut, a lost executor does not lose it, and all readers see one result.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialized_side(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A join side derived from the data: compute it once, then broadcast it if its files are small.

    The check is on the bytes just written, so neither a second job nor a guess is needed.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "join-side")
    df.write.parquet(path)
    side = spark.read.schema(df.schema).parquet(path)
    return F.broadcast(side) if storage.size_of(spark, path) <= max_bytes else side
