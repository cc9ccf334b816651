"""JDBC and managed-table sinks.

Rows are written by the executors in parallel (one connection per partition,
``batchsize`` rows per round trip, one transaction per partition); nothing is
collected to the driver. Errors fail the job instead of being swallowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_append(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    batchsize: int = 1000,
    num_partitions: int | None = None,
) -> None:
    """Append ``df`` to ``table`` (batch insert; creates the table when missing)."""
    writer = df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
    writer = writer.option("batchsize", str(batchsize))
    if num_partitions:
        # Caps concurrent connections to the database.
        writer = writer.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()


def jdbc_execute_rows(spark: SparkSession, url: str, table: str, rows: list[tuple], columns: list[str],
                      properties: dict[str, str] | None = None) -> None:
    """Single-statement style insert of a few parameter rows (e.g. one result row)."""
    jdbc_append(spark.createDataFrame(rows, columns), url, table, properties)


def jdbc_read(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def replace_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    """Replace a managed table with ``df`` (no separate DROP; one overwrite)."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
