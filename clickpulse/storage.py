"""The one place that talks to the Hadoop file system through the driver's JVM.

Paths may be on any store Spark can read (``hdfs://``, ``s3a://``, ``file:``). Only folder
bookkeeping happens here (exists, list, rename, delete); data is always read and written by Spark.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    p, fs = _path(spark, path)
    return int(fs.getContentSummary(p).getLength())


def make_dirs(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, source: str, target: str) -> bool:
    p, fs = _path(spark, source)
    return bool(fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target)))


def list_folders(spark: SparkSession, path: str, key: str | None = None) -> list[str]:
    """Names of the sub-folders of ``path`` (``key``: only ``key=...``, returned as the value)."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    if key is None:
        return sorted(names)
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{key}="))


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a glob pattern."""
    p, fs = _path(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(p) or []]


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Remove the folder when the driver's JVM ends (scratch data of lazily read results)."""
    p, fs = _path(spark, path)
    fs.deleteOnExit(p)
