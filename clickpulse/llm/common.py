"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickpulse.session import scratch_dir

# Words of the documents: runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
ROWS_A_FILE = 1 << 18  # of a narrow table (a few numbers a row) whose number of files is chosen


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def files_for(rows: int) -> int:
    """Files for a narrow table of about ``rows`` rows."""
    return max(1, -(-rows // ROWS_A_FILE))


def written(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write ``df`` once under the shared scratch folder and read it back.

    Later steps then see one fixed result (lineage is cut; a lost executor loses nothing). Without
    ``files`` every task writes one. Hadoop's local file system launches processes from the executor
    for each file (``chmod``), so narrow tables are dealt out evenly to ``files`` tasks instead.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    (df if files is None else df.repartition(files)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_arrow_batches(spark: SparkSession, rows: int = 500, megabytes: int = 4) -> None:
    """Bound what one Arrow batch hands to a Python worker (session settings; long texts count by bytes)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))


def running_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """Every row with, for each name of ``sums``, the sum over all rows up to it and itself in ``order``.

    No task ever holds more than its slice: rows are dealt out by range of the whole sort key
    (a hot leading value is cut into several slices), written once with their slice number, and
    each slice adds the totals of those before it (one row per slice, at most the number of
    shuffle partitions). ``order`` must be total up to rows that are equal for the caller.
    """
    rows = df.withColumns({f"_add_{k}": v for k, v in sums.items()})
    cut = written(rows.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), name)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy("_slice").agg(*[F.sum(f"_add_{k}").alias(f"_all_{k}") for k in sums])
    starts = starts.select("_slice", *[F.coalesce(F.sum(f"_all_{k}").over(before), F.lit(0)).alias(f"_start_{k}")
                                       for k in sums])
    inside = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = cut.join(F.broadcast(starts), "_slice")
    out = out.withColumns({k: F.col(f"_start_{k}") + F.sum(f"_add_{k}").over(inside) for k in sums})
    return out.drop("_slice", *[f"_add_{k}" for k in sums], *[f"_start_{k}" for k in sums])


def uniform(seed: int, *cols: Column) -> Column:
    """A number in (0, 1) that depends on the columns' text and the seed alone (52 bits of MD5)."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))
