"""Ad-click guard (job Q5): block users who click one ad too often in a day.

Semantics: the rows of micro-batch n are filtered by the users blocked after
batch n-1; accepted rows add to the running (date, user, ad) counts; a user
whose count reaches ``threshold`` is blocked for all later batches, on all
ads, for ever. One ``foreachBatch`` does the whole step:

1. the batch's distinct users meet the blocked users of versions < n; the few that are blocked filter
   the batch (``left_anti``; Spark broadcasts them when they are few, and splits a hot user if not);
2. accepted rows -> ``accepted/batch_id=n`` (the fan-out table for Q6-Q8);
3. per-batch increments per (date, user, ad) -> the counts table;
4. totals of the days this batch touched -> users at or over the threshold and not yet blocked -> the
   blocked table.

Both state tables are bucketed by user (``sinks.keyed``): their rows are never shuffled, whole days
and batches are pruned through the catalog, and runs of batches fold by size tiers.

Every write replaces only its own batch, accepted rows are written once per batch (a marker is made
after the write), and every read takes versions <= n, so a replayed batch gives the same state:
exactly-once on top of the checkpointed source offsets.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse import constants as C
from clickpulse import storage
from clickpulse.sinks.keyed import FAN_IN, NO_DAY, KeyedTable, Run

ACCEPTED_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("area", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("userid", T.StringType()),
        T.StructField("adid", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("date", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
COUNTS_SCHEMA = T.StructType(
    [
        T.StructField("userid", T.StringType()),
        T.StructField("adid", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("date", T.StringType()),
    ]
)
BLOCKED_SCHEMA = T.StructType([T.StructField("userid", T.StringType()), T.StructField("block_batch", T.LongType())])


class AdClickGuard:
    def __init__(self, spark: SparkSession, root: str, threshold: int = C.BLOCK_THRESHOLD,
                 compact_every: int = FAN_IN, buckets: int | None = None):
        """``compact_every``: how many runs of one level fold into one (0: never); ``buckets``: of the state tables."""
        self.spark = spark
        self.threshold = threshold
        self.accepted_path = os.path.join(root, "accepted")
        self.commits_path = os.path.join(root, "commits")
        self.counts = KeyedTable(spark, os.path.join(root, "counts"), ["date", "userid", "adid"], COUNTS_SCHEMA, "date",
                                 "sum", ["userid"], buckets, compact_every)
        self.blocks = KeyedTable(spark, os.path.join(root, "blocked"), ["userid"], BLOCKED_SCHEMA, None, "min", ["userid"], buckets, compact_every)
        spark.createDataFrame([], ACCEPTED_SCHEMA).write.mode("append").partitionBy("batch_id").parquet(self.accepted_path)

    # readers --------------------------------------------------------------
    def accepted(self) -> DataFrame:
        return self.spark.read.schema(ACCEPTED_SCHEMA).parquet(self.accepted_path)

    def accepted_of(self, batch_id: int) -> DataFrame:
        """The accepted rows of one batch; only its folder is listed."""
        folder = f"{self.accepted_path}/batch_id={int(batch_id)}"
        if not storage.exists(self.spark, folder):
            return self.spark.createDataFrame([], ACCEPTED_SCHEMA)
        return self.spark.read.schema(ACCEPTED_SCHEMA).option("basePath", self.accepted_path).parquet(folder)

    def blocked(self, before_batch: int | None = None, runs: list[Run] | None = None) -> DataFrame:
        """``userid, block_batch`` (the batch after which the user is blocked)."""
        return self.blocks.read(None if before_batch is None else int(before_batch) - 1, runs=runs)

    def user_day_counts(self, upto_batch: int | None = None, dates: list[str] | None = None, runs: list[Run] | None = None) -> DataFrame:
        """Running accepted clicks per (date, userid, adid); with ``dates`` of these days only."""
        return self.counts.read(upto_batch, dates, runs).select("date", "userid", "adid", "n")

    # the micro-batch step -------------------------------------------------------
    def accepted_written(self, batch_id: int) -> bool:
        """Whether all rows of the batch are in ``accepted`` (its marker is made after the write)."""
        return storage.exists(self.spark, f"{self.commits_path}/{int(batch_id)}")

    def filtered(self, batch: DataFrame, batch_id: int, runs: list[Run] | None = None) -> DataFrame:
        """The batch without users blocked before it (a null user is kept)."""
        runs = self.blocks.runs([NO_DAY]) if runs is None else runs
        if not runs:
            return batch
        hit = batch.select("userid").distinct().join(self.blocked(batch_id, runs).select("userid"), "userid", "left_semi")
        return batch.join(hit, "userid", "left_anti")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        n = int(batch_id)
        if "event_id" not in batch.columns:  # line sources (Kafka value, text files) carry no id
            batch = batch.withColumn("event_id", F.lit(None).cast("long"))
        block_runs = self.blocks.runs([NO_DAY])  # asked of the catalog once a batch
        # Accepted rows are write-once: downstream file streams read this table, so a
        # replayed batch must not put new files next to the ones already read.
        if not self.accepted_written(n):
            columns = [f.name for f in ACCEPTED_SCHEMA.fields if f.name != "batch_id"]
            self.filtered(batch, n, block_runs).select(*columns).write.mode("overwrite").parquet(f"{self.accepted_path}/batch_id={n}")
            storage.make_dirs(self.spark, f"{self.commits_path}/{n}")
            for old in storage.list_folders(self.spark, self.commits_path):
                if old.isdigit() and int(old) < n:  # only batch n can still be replayed
                    storage.delete(self.spark, f"{self.commits_path}/{old}")

        # Re-read what was just written instead of recomputing the batch.
        inc = self.accepted_of(n).groupBy("date", "userid", "adid").agg(F.count(F.lit(1)).alias("n"))
        self.counts.upsert(inc, n)
        days = self.counts.partitions_of_version(n)
        if days:
            runs = self.counts.runs([NO_DAY if d is None else d for d in days])
            self.blocks.upsert(self.newly_blocked(n, days, runs, block_runs), n)
            self.counts.fold(n, days, runs)
            self.blocks.fold(n, runs=block_runs)

    def newly_blocked(self, batch_id: int, days: list[str | None], runs: list[Run] | None = None, block_runs: list[Run] | None = None) -> DataFrame:
        """Users whose count of some day of ``days`` reached the threshold by this batch and who were not blocked before."""
        over = self.user_day_counts(batch_id, days, runs).where(F.col("n") >= self.threshold).select("userid").distinct()
        before = self.blocked(batch_id, block_runs).select("userid")
        return over.join(before, "userid", "left_anti").select("userid", F.lit(int(batch_id)).cast("long").alias("block_batch"))

    def expire_accepted(self, before_batch: int) -> None:
        """Delete accepted rows of older batches, once nothing downstream reads them any more; state stays."""
        for b in storage.list_folders(self.spark, self.accepted_path, "batch_id"):
            if b.isdigit() and int(b) < int(before_batch):
                storage.delete(self.spark, f"{self.accepted_path}/batch_id={b}")
