"""Per-ad minute trend over the last hour (job Q8) and sliding counts on a stream.

No row is ever late: each micro-batch adds its own counts per (ad, event-time minute), or per slide
bucket, as increments, so rows may arrive in any order and the totals equal the batch formulas.
Nothing is kept in a state store, and there is no watermark that could drop rows. Increments are
partitioned by day, and a batch never reads older ones to add its own.

The trend's clock is the latest minute seen that is not in the future of the batch's arrival (plus a
tolerance): a wrongly dated line is counted, but does not move the clock. The arrival is kept with
the batch, so a replay gives the same clock. Times are wall-clock
(``timestamp_ntz``), so no session time zone leaks into the keys.
"""

from __future__ import annotations

import datetime as dt
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.functions.jsonpairs import pairs_json
from clickpulse.functions.timefmt import minute_label, minute_start
from clickpulse.operators.ads import slide_bucket, windows_of_buckets
from clickpulse.sinks.keyed import FAN_IN, KeyedTable, SnapshotTable

MINUTE_SCHEMA = T.StructType(
    [
        T.StructField("adid", T.StringType()),
        T.StructField("minute", T.TimestampNTZType()),
        T.StructField("n", T.LongType()),
        T.StructField("date", T.StringType()),
    ]
)
CLOCK_SCHEMA = T.StructType([T.StructField("clock", T.StringType()), T.StructField("now", T.TimestampNTZType()), T.StructField("arrival", T.LongType())])
TREND_SCHEMA = T.StructType([T.StructField("adid", T.StringType()), T.StructField("trend_json", T.StringType())])


def _epoch_ntz():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _micros(ts):
    return F.timestamp_diff("MICROSECOND", _epoch_ntz(), ts)


def _from_micros(us):
    return F.timestamp_add("MICROSECOND", us, _epoch_ntz())


BUCKET_SCHEMA = T.StructType(
    [
        T.StructField("adid", T.StringType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("date", T.StringType()),
    ]
)
FUTURE_MINUTES = 60  # how far ahead of its arrival a line may be dated and still move the clock


class SlidingTables:
    """Clicks per (ad, slide bucket), added batch by batch; windows are summed when they are read."""

    def __init__(self, spark: SparkSession, root: str, length_minutes: int = 3, slide_minutes: int = 1, compact_every: int = FAN_IN):
        self.length, self.slide = length_minutes, slide_minutes
        self.buckets = KeyedTable(spark, os.path.join(root, "buckets"), ["date", "adid", "bucket"], BUCKET_SCHEMA, "date", "sum", ["adid"],
                                  fan_in=compact_every)

    def add_rows(self, rows: DataFrame, batch_id: int) -> None:
        """One micro-batch of clicks (adid, ts)."""
        day = F.date_format("ts", "yyyy-MM-dd").alias("date")
        inc = rows.groupBy("adid", slide_bucket(F.col("ts"), self.slide).alias("bucket"), day).agg(F.count(F.lit(1)).alias("n"))
        self.buckets.upsert(inc, batch_id)
        self.buckets.fold(batch_id, self.buckets.partitions_of_version(batch_id))

    def read(self) -> DataFrame:
        return windows_of_buckets(self.buckets.read().select("adid", "bucket", "n"), self.length, self.slide)


class TrendTables:
    def __init__(self, spark: SparkSession, root: str, length_minutes: int = 60, compact_every: int = FAN_IN):
        self.spark = spark
        self.length = length_minutes
        # date is a function of minute; keeping it in the key lets date filters reach the partitions.
        self.minutes = KeyedTable(spark, os.path.join(root, "ad_minutes"), ["date", "adid", "minute"], MINUTE_SCHEMA, "date", "sum", ["adid"],
                                  fan_in=compact_every)
        self.clock = KeyedTable(spark, os.path.join(root, "clock"), ["clock"], CLOCK_SCHEMA, buckets=1, fan_in=compact_every)
        self.trend = SnapshotTable(spark, os.path.join(root, "last_hour_trend"), TREND_SCHEMA)

    def add_rows(self, rows: DataFrame, batch_id: int, arrival: int | None = None) -> None:
        """One micro-batch of clicks (adid, ts)."""
        self.add_increments(rows.groupBy("adid", minute_start(F.col("ts")).alias("minute")).agg(F.count(F.lit(1)).alias("n")), batch_id, arrival)

    def arrival_of(self, batch_id: int) -> int | None:
        """When the batch was first processed (epoch microseconds); None if it was not, or held no row that counts."""
        if not self.clock.written(batch_id):
            return None
        return self.clock.rows_of(batch_id).select("arrival").first()[0]

    def now_micros(self, upto_version: int | None = None) -> int | None:
        """Latest minute seen, as epoch microseconds (no Python datetimes: zone-free)."""
        rows = self.clock.read(upto_version).select(_micros(F.col("now"))).collect()  # one row
        return rows[0][0] if rows else None

    def add_increments(self, inc: DataFrame, batch_id: int, arrival: int | None = None) -> None:
        """Add one batch's per-(adid, minute) counts to the minute totals and rebuild the trend.

        ``arrival`` (default: the clock time now) is kept with the batch, so a replay, however much
        later, gives the same trend.
        """
        n = int(batch_id)
        first = self.arrival_of(n)
        arrival = first if first is not None else int(time.time() * 1_000_000) if arrival is None else int(arrival)
        # One action on the micro-batch (the upsert); the batch's latest minute is then read
        # from what it wrote (partition-pruned), not by re-running the stream plan.
        self.minutes.upsert(inc.withColumn("date", F.date_format("minute", "yyyy-MM-dd")), n)
        days = self.minutes.partitions_of_version(n)
        latest = None
        if days:
            known = self.minutes.rows_of(n).where(_micros(F.col("minute")) <= F.lit(arrival + FUTURE_MINUTES * 60_000_000))
            latest = known.agg(F.max(_micros(F.col("minute")))).first()[0]
        prev = self.now_micros(upto_version=n - 1)
        seen = [x for x in (latest, prev) if x is not None]
        if not seen:
            return
        now = max(seen)
        now_col = _from_micros(F.lit(now))
        self.clock.upsert(self.spark.range(1).select(F.lit("clock").alias("clock"), now_col.alias("now"), F.lit(arrival).cast("long").alias("arrival")), n)
        cut = F.timestamp_add("MINUTE", F.lit(-self.length), now_col)
        recent = self.minutes.read(n, _days_between(now - self.length * 60_000_000, now)).where((F.col("minute") > cut) & (F.col("minute") <= now_col))
        lists = recent.groupBy("adid").agg(
            F.array_sort(F.collect_list(F.struct("minute", minute_label(F.col("minute")).alias("k"), "n"))).alias("items")
        )
        self.trend.replace(lists.select("adid", pairs_json(F.col("items")).alias("trend_json")), n)
        self.minutes.fold(n, days)
        self.clock.fold(n)


def _days_between(first: int, last: int) -> list[str]:
    """``yyyy-MM-dd`` of the days that two wall-clock times in epoch microseconds span."""
    day = 86_400_000_000
    start = dt.date(1970, 1, 1)
    return [(start + dt.timedelta(days=d)).isoformat() for d in range(first // day, last // day + 1)]
