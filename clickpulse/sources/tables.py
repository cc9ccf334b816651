"""Batch table readers (parquet paths or catalog tables)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read ``{sf_dir}/{name}.parquet`` (or a directory of that name)."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)


def read_named(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table by name (Hive/managed table or temp view)."""
    return spark.table(name)
