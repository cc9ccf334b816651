"""The ad-click streaming application: guard, then fan-out to Q6/Q7/Q8.

One query runs the guard (``AdClickGuard.process`` in ``foreachBatch``) and
writes the accepted rows once per batch. The fan-out to running per-(day, area,
city, ad) counts with the day/area top-n (Q6, Q7) and the per-ad minute trend
(Q8) comes in two forms:

- ``fanout="stream"``: two more streaming queries read the accepted
  table as a file source and keep their running counts in Spark's state store;
  each has its own checkpoint.
- ``fanout="inline"`` (default): the guard's batch also counts its accepted rows for all results in one
  aggregate and adds the counts to the result tables as increments. One query, no re-listing of the
  accepted files, exact (no watermark).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickpulse import constants as C
from clickpulse.functions.timefmt import minute_start
from clickpulse.operators.ads import parse_ads_lines
from clickpulse.session import stream_session
from clickpulse.streaming.counts import DayAreaAdTables, day_area_city_counts_stream
from clickpulse.streaming.feed import start_foreach_batch
from clickpulse.streaming.guard import ACCEPTED_SCHEMA, AdClickGuard
from clickpulse.streaming.trend import TrendTables


class AdsApp:
    def __init__(self, spark: SparkSession, root: str, threshold: int = C.BLOCK_THRESHOLD, top_n: int = C.TOP_ADS,
                 trend_minutes: int = C.TREND_MINUTES, tz: str = "UTC", retain_days: int | None = None,
                 state_partitions: int | None = None, fanout: str = "inline"):
        if fanout not in ("stream", "inline"):
            raise ValueError("fanout must be 'stream' or 'inline'")
        self.fanout = fanout
        self.spark = spark
        # Streams run in their own session when a state-partition count is given (see stream_session).
        self.stream_spark = stream_session(spark, state_partitions) if state_partitions else spark
        self.retain_days = retain_days  # None: keep running counts for ever (exact)
        self.root = root
        self.tz = tz
        self.trend_minutes = trend_minutes
        self.guard = AdClickGuard(spark, os.path.join(root, "guard"), threshold)
        self.day_area = DayAreaAdTables(spark, os.path.join(root, "day_area"), top_n, increments=fanout == "inline")
        self.trend = TrendTables(spark, os.path.join(root, "trend"), trend_minutes)
        self.rejects_path = os.path.join(root, "rejects")
        spark.createDataFrame([], "line string, reason string, batch_id long").write.mode("append") \
            .partitionBy("batch_id").parquet(self.rejects_path)

    def _ckpt(self, name: str) -> str:
        return os.path.join(self.root, "checkpoints", name)

    def accepted_stream(self) -> DataFrame:
        return self.stream_spark.readStream.schema(ACCEPTED_SCHEMA).parquet(self.guard.accepted_path)

    def process_lines(self, lines: DataFrame, batch_id: int) -> None:
        """One micro-batch of raw lines: rejects to ``rejects/batch_id=n``, the rest through the guard."""
        lines = lines.persist()  # parsed twice (rejects, accepted); read the source once
        try:
            parsed, rejects = parse_ads_lines(lines, self.tz)
            (rejects.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(self.rejects_path))
            self.guard.process(parsed, batch_id)
        finally:
            lines.unpersist()
        if self.fanout == "inline":
            self._fan_out(int(batch_id))

    def _fan_out(self, n: int) -> None:
        """Inline fan-out of batch ``n``: its accepted rows are read once and counted for all results at once.

        One aggregate over two grouping sets (Spark expands each row to both before the partial
        aggregation); a row belongs to a result by its grouping id, so null keys are keys like any other.
        """
        rows = self.guard.accepted_of(n).select("date", "area", "city", "adid", minute_start(F.col("ts")).alias("minute"))
        cols = [F.col(c) for c in ("date", "area", "city", "adid", "minute")]
        sets = rows.groupingSets([[F.col(c) for c in ("date", "area", "city", "adid")], [F.col("adid"), F.col("minute")]], *cols)
        counts = sets.agg(F.count(F.lit(1)).alias("n"), F.grouping("minute").alias("without_minute")).persist()
        try:
            self.day_area.process(counts.where("without_minute = 1").select("date", "area", "city", "adid", "n"), n)
            self.trend.add_increments(counts.where("without_minute = 0").select("adid", "minute", "n"), n)
        finally:
            counts.unpersist()

    def rejects(self) -> DataFrame:
        """Malformed lines with their reason and batch."""
        return self.spark.read.schema("line string, reason string, batch_id long").parquet(self.rejects_path)

    def start_guard(self, lines: DataFrame, available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
        """``lines``: a stream with a string ``value`` column (Kafka value, text file line, ...)."""
        return start_foreach_batch(lines, self.process_lines, self._ckpt("guard"), "append",
                                   available_now, processing_time)

    def start_downstream(self, available_now: bool = True, processing_time: str | None = None) -> list[StreamingQuery]:
        if self.fanout == "inline":
            return []  # done inside the guard's batches
        acc = self.accepted_stream()
        q6 = start_foreach_batch(day_area_city_counts_stream(acc, self.retain_days), self.day_area.process,
                                 self._ckpt("day_area"),
                                 "update", available_now, processing_time)
        q8 = start_foreach_batch(acc.select("adid", "ts"), self.trend.add_rows,
                                 self._ckpt("trend"), "append", available_now, processing_time)
        return [q6, q8]

    def run_available(self, lines: DataFrame) -> None:
        """Process everything available now: the guard first, then the fan-out."""
        q = self.start_guard(lines)
        q.awaitTermination()
        for d in self.start_downstream():
            d.awaitTermination()
