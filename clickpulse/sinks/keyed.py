"""Keyed result tables written from ``foreachBatch``.

``KeyedTable`` takes each micro-batch's rows as a *run* and merges runs when it is read: by the newest
row of a key (an upsert sink), by sums (an increment sink) or by minima (a set with its first batch).
A write costs O(batch), never a look at older rows, and a replayed batch overwrites its own run. Runs
are partitions of a bucketed table in Spark's catalog: readers prune by day and batch without
listing other folders, and rows of a key lie in one bucket, so merging runs and joining on the
bucket columns shuffle nothing on the table's side.

Runs are folded by size tiers: ``fan_in`` neighbouring runs of one level become one run of the next,
so a row is rewritten a logarithmic number of times and a day has a logarithmic number of runs.

``SnapshotTable`` is a replace sink: every batch writes a complete snapshot
under its own version and readers take the newest one, so a reader never sees
a half-deleted table and a batch with no rows still replaces stale values.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse import storage

VERSION = "_version"
MARKER = "_marker"  # true on the one row that makes a snapshot version exist
DAY = "_day"
NO_DAY = "-"  # partition of rows whose partition column is null
FAN_IN = 8


class Run(NamedTuple):
    """The batches ``lo`` to ``hi`` of one day, merged ``level`` times."""

    day: str
    lo: int
    hi: int
    level: int


def visible(runs: list[Run], upto: int | None = None) -> list[Run]:
    """The runs a reader takes, oldest first: those up to a batch that lie in no larger run.

    A fold that was cut short leaves the runs it read next to the one it wrote.
    """
    out: list[Run] = []
    for r in sorted((r for r in runs if upto is None or r.hi <= upto), key=lambda r: (r.day, r.lo, -r.hi, -r.level)):
        if not out or out[-1].day != r.day or r.lo > out[-1].hi:
            out.append(r)
    return out


def tier(runs: list[Run], fan_in: int) -> Run | None:
    """The run into which the newest of one day's visible runs fold, or None while no level is full."""
    merged = None
    rest = list(runs)
    for level in range(max((r.level for r in runs), default=-1) + 1):
        tail = [r for r in rest if r.level <= level]
        if sum(r.level == level for r in tail) < fan_in:
            continue
        merged = Run(tail[0].day, tail[0].lo, tail[-1].hi, level + 1)
        rest = [r for r in rest if r.level > level] + [merged]
        rest.sort(key=lambda r: r.lo)
    return merged


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: T.StructType,
                 partition_col: str | None = None, merge: str = "latest", bucket_by: list[str] | None = None,
                 buckets: int | None = None, fan_in: int = FAN_IN):
        """``merge``: "latest", "sum" or "min" of the columns that are no keys. ``fan_in`` 0: never fold.

        ``bucket_by`` defaults to the last key; ``buckets`` to half the cluster's cores. A folder that
        exists keeps the number of buckets and the merge it was made with.
        """
        if merge not in ("latest", "sum", "min"):
            raise ValueError("merge must be 'latest', 'sum' or 'min'")
        self.spark = spark
        self.path = path
        self.keys = list(keys)
        self.schema = schema  # value schema including keys
        self.partition_col = partition_col
        self.merge = merge
        self.bucket_by = list(bucket_by or self.keys[-1:])
        self.fan_in = fan_in
        made = storage.list_folders(spark, path, "buckets")
        if made:  # how a table is bucketed and merged stays with its folder
            count, self.merge = made[0].split("-")
            buckets = int(count)
        self.buckets = buckets or max(1, spark.sparkContext.defaultParallelism // 2)
        self.location = f"{path}/buckets={self.buckets}-{self.merge}"
        self.name = "keyed_" + hashlib.md5(self.location.encode()).hexdigest()
        self.values = [f.name for f in schema.fields if f.name not in self.keys]
        self._define(bool(made))

    def _define(self, made: bool) -> None:
        """Put the table into this application's catalog; folders of an earlier application are found once."""
        if self.spark.catalog.tableExists(self.name):
            return
        storage.make_dirs(self.spark, self.location)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, `{DAY}` STRING, lo BIGINT, hi BIGINT, level INT) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (`{DAY}`, lo, hi, level) "
            f"CLUSTERED BY ({', '.join(f'`{c}`' for c in self.bucket_by)}) INTO {self.buckets} BUCKETS LOCATION '{self.location}'")
        if made:
            self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    # runs -----------------------------------------------------------------------
    def runs(self, days: list[str] | None = None, batch: int | None = None) -> list[Run]:
        """Partitions in the catalog (no folder is listed): all, of some days, or written by one batch."""
        text = lambda d: "'" + d.replace("\\", "\\\\").replace("'", "\\'") + "'"
        specs = [f" PARTITION (`{DAY}` = {text(d)})" for d in days] if days is not None else [""]
        if batch is not None:
            specs = [f" PARTITION (lo = {int(batch)}, hi = {int(batch)})"]
        out = []
        for spec in specs:
            for row in self.spark.sql(f"SHOW PARTITIONS {self.name}{spec}").collect():
                day, lo, hi, level = (unquote(x.split("=", 1)[1]) for x in row[0].split("/"))
                out.append(Run(day, int(lo), int(hi), int(level)))
        return out

    def _days(self, partitions: list | None) -> list[str] | None:
        if not self.partition_col:
            return [NO_DAY]
        return None if partitions is None else [NO_DAY if p is None else str(p) for p in partitions]

    def partitions_of_version(self, batch_id: int) -> list[str | None]:
        """Values of the partition column that batch ``batch_id`` wrote (from the catalog, no job)."""
        if not self.partition_col:
            return []
        found = sorted({r.day for r in self.runs(batch=batch_id) if r.level == 0})
        return [None if d == NO_DAY else d for d in found]

    def written(self, batch_id: int) -> bool:
        """Whether the batch has a run (a batch without rows has none)."""
        return any(r.level == 0 for r in self.runs(batch=batch_id))

    # writes ---------------------------------------------------------------------
    def _insert(self, rows: DataFrame) -> None:
        cols = [*[f.name for f in self.schema.fields], DAY, "lo", "hi", "level"]
        rows.repartition(self.buckets, *self.bucket_by).select(*cols).write.mode("overwrite").insertInto(self.name)

    def upsert(self, df: DataFrame, batch_id: int) -> None:
        """The rows of one batch: at most one per key. Replaces what the batch wrote before."""
        day = F.coalesce(F.col(self.partition_col).cast("string"), F.lit(NO_DAY)) if self.partition_col else F.lit(NO_DAY)
        n = F.lit(int(batch_id)).cast("long")
        self._insert(df.select(*[f.name for f in self.schema.fields], day.alias(DAY), n.alias("lo"), n.alias("hi"), F.lit(0).alias("level")))

    def fold(self, batch_id: int, partitions: list | None = None, runs: list[Run] | None = None) -> None:
        """Fold full levels of the given partitions (default: all); call it inside batch ``batch_id``.

        Only batch ``batch_id`` can still be replayed, and its own run is never folded. Readers
        get the same values before, during and after. ``runs``: of these partitions, if the caller has them.
        """
        if self.fan_in:
            self._fold(batch_id, partitions, lambda rs: tier(rs, max(2, self.fan_in)), runs)

    def compact(self, batch_id: int, partitions: list | None = None) -> None:
        """Fold every run below ``batch_id`` into one per partition, whatever its level (housekeeping)."""
        self._fold(batch_id, partitions, lambda runs: Run(runs[0].day, runs[0].lo, runs[-1].hi, max(r.level for r in runs) + 1) if len(runs) > 1 else None)

    def _fold(self, batch_id: int, partitions: list | None, choose, runs: list[Run] | None = None) -> None:
        runs = self.runs(self._days(partitions)) if runs is None else runs
        seen = set(visible(runs))
        self._drop([r for r in runs if r not in seen])  # what a fold that was cut short left behind
        by_day: dict[str, list[Run]] = {}
        for r in visible(runs, int(batch_id) - 1):
            by_day.setdefault(r.day, []).append(r)
        goals = [g for g in map(choose, by_day.values()) if g]
        if not goals:
            return
        plan = self.spark.createDataFrame(goals, "to_day string, to_lo long, to_hi long, to_level int")
        rows = self._rows([r for r in visible(runs, int(batch_id) - 1) if any(g.day == r.day and g.lo <= r.lo and r.hi <= g.hi for g in goals)])
        merged = self._merge(rows, [DAY]).join(F.broadcast(plan), F.col(DAY) == F.col("to_day"))
        self._insert(merged.select(*[f.name for f in self.schema.fields], DAY, F.col("to_lo").alias("lo"), F.col("to_hi").alias("hi"), F.col("to_level").alias("level")))
        self._drop([r for r in seen if any(r != g and r.day == g.day and g.lo <= r.lo and r.hi <= g.hi for g in goals)])

    def _drop(self, runs: list[Run]) -> None:
        text = lambda d: "'" + d.replace("\\", "\\\\").replace("'", "\\'") + "'"
        specs = [f"PARTITION (`{DAY}` = {text(r.day)}, lo = {r.lo}, hi = {r.hi}, level = {r.level})" for r in runs]
        if not specs:
            return
        folders = [f"{self.location}/{DAY}={r.day}/lo={r.lo}/hi={r.hi}/level={r.level}" for r in runs]
        self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {', '.join(specs)}")
        for f in folders:
            storage.delete(self.spark, f)

    # reads ----------------------------------------------------------------------
    def _rows(self, runs: list[Run] | None, stale: list[Run] = ()) -> DataFrame:
        rows = self.spark.table(self.name)
        one = lambda r: (F.col(DAY) == r.day) & (F.col("lo") == r.lo) & (F.col("hi") == r.hi) & (F.col("level") == r.level)
        if runs is not None:
            keep = F.lit(False)
            for r in runs:
                keep = keep | one(r)
            rows = rows.where(keep)
        for r in stale:
            rows = rows.where(~one(r))
        return rows

    def _merge(self, rows: DataFrame, more: list[str] = ()) -> DataFrame:
        by = [*self.keys, *[c for c in more if c not in self.keys]]
        cast = {f.name: f.dataType for f in self.schema.fields}
        if self.merge == "latest":
            newest = rows.groupBy(*by).agg(F.max_by(F.struct(*self.values), F.col("hi")).alias("_v"))
            return newest.select(*by, *[F.col(f"_v.{v}").alias(v) for v in self.values])
        fn = F.sum if self.merge == "sum" else F.min
        return rows.groupBy(*by).agg(*[fn(v).cast(cast[v]).alias(v) for v in self.values])

    def versions(self) -> DataFrame:
        """All stored rows with the newest batch of their run."""
        return self.spark.table(self.name).select(*[f.name for f in self.schema.fields], F.col("hi").alias(VERSION))

    def rows_of(self, batch_id: int) -> DataFrame:
        """What one batch wrote."""
        n = int(batch_id)
        return self.spark.table(self.name).where((F.col("lo") == n) & (F.col("hi") == n) & (F.col("level") == 0)).select(*[f.name for f in self.schema.fields])

    def read(self, upto_version: int | None = None, partitions: list | None = None, runs: list[Run] | None = None) -> DataFrame:
        """The merged value of every key, from batches up to ``upto_version`` and, if given, some partitions.

        ``runs``: of these partitions, if the caller has them.
        """
        days = self._days(partitions)
        if runs is None:
            runs = self.runs(days if partitions is not None and self.partition_col else None)
        taken = set(visible(runs, upto_version))
        known = [r for r in runs if upto_version is None or r.hi <= upto_version]
        rows = self._rows(None, [r for r in known if r not in taken])
        if upto_version is not None:
            rows = rows.where(F.col("hi") <= int(upto_version))
        if partitions is not None and self.partition_col:
            rows = rows.where(F.col(DAY).isin(days))
        return self._merge(rows).select(*[f.name for f in self.schema.fields])


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark = spark
        self.path = path
        self.schema = schema
        empty = spark.createDataFrame([], self._stored_schema())
        empty.write.mode("append").partitionBy(VERSION).parquet(path)

    def _stored_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(MARKER, T.BooleanType()), T.StructField(VERSION, T.LongType())])

    def replace(self, df: DataFrame, batch_id: int) -> None:
        n = int(batch_id)
        rows = df.select(*[f.name for f in self.schema.fields], F.lit(False).alias(MARKER))
        # One all-null marker row makes the new version exist even when the snapshot is
        # empty (so it still replaces the previous one); readers drop it.
        marker = self.spark.createDataFrame([(None,) * len(self.schema.fields) + (True,)], rows.schema)
        rows.unionByName(marker).write.mode("overwrite").parquet(f"{self.path}/{VERSION}={n}")
        # Keep the previous snapshot for readers in flight; older ones go.
        for v in storage.list_folders(self.spark, self.path, VERSION):
            if v.lstrip("-").isdigit() and int(v) < n - 1:
                storage.delete(self.spark, f"{self.path}/{VERSION}={v}")

    def read(self) -> DataFrame:
        rows = self.spark.read.schema(self._stored_schema()).parquet(self.path)
        newest = rows.select(F.max(VERSION)).scalar()
        return rows.where((F.col(VERSION) == newest) & ~F.col(MARKER)).drop(MARKER, VERSION)
