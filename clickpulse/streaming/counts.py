"""Running counts on streams (jobs Q6, Q7 and the word-count sample).

The running totals live in Spark's state store (streaming ``groupBy().count()``
in *update* mode: each batch emits only the keys it changed, with their new
totals). ``foreachBatch`` writes them to a ``KeyedTable`` partitioned by
``date``; Q7 (roll-up to area + top-n + JSON) then runs on that table for the
days the batch touched only, because Structured Streaming rejects a second
aggregation and a ranking window on the same stream.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.operators.ads import day_area_ad_counts, day_area_ad_top_n
from clickpulse.sinks.keyed import FAN_IN, KeyedTable

DAY_AREA_CITY_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("area", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("adid", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)
TOP_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("area", T.StringType()),
        T.StructField("top_json", T.StringType()),
    ]
)
WORD_SCHEMA = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])


def day_area_city_counts_stream(ads_stream: DataFrame, retain_days: int | None = None) -> DataFrame:
    """Streaming running clicks per (date, area, city, adid); run in update mode.

    By default every key is kept for ever (exact, like the surveyed job). With
    ``retain_days`` the count runs over event-time day windows under a watermark of
    that many days, so the state of older days is dropped (and rows arriving later
    than that for those days are ignored): state stays bounded on an endless stream.
    """
    if retain_days is None:
        return ads_stream.groupBy("date", "area", "city", "adid").agg(F.count(F.lit(1)).alias("n"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    event_time = F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col("ts")))
    counted = (
        ads_stream.withColumn("_et", event_time)
        .withWatermark("_et", f"{int(retain_days)} days")
        .groupBy(F.window("_et", "1 day").alias("d"), "area", "city", "adid")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    day = F.date_format(F.timestamp_add("MICROSECOND", F.unix_micros(F.col("d.start")), epoch), "yyyy-MM-dd")
    return counted.select(day.alias("date"), "area", "city", "adid", "n")


def word_count_stream(lines: DataFrame, column: str = "text", sep: str = " ") -> DataFrame:
    """Streaming running word counts (empty tokens dropped); run in update mode."""
    words = lines.select(F.explode(F.split(F.col(column), sep)).alias("word")).where(F.col("word") != "")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


class DayAreaAdTables:
    """Sinks of Q6 (per city) and Q7 (top-n per day and area).

    ``increments``: the batches bring counts to add (inline fan-out) instead of running totals from the state store.
    """

    def __init__(self, spark: SparkSession, root: str, top_n: int = 3, compact_every: int = FAN_IN, increments: bool = False):
        self.spark = spark
        self.top_n = top_n
        self.city_counts = KeyedTable(spark, os.path.join(root, "day_area_city_ads"), ["date", "area", "city", "adid"], DAY_AREA_CITY_SCHEMA,
                                      "date", "sum" if increments else "latest", fan_in=compact_every)
        self.top = KeyedTable(spark, os.path.join(root, "day_area_top"), ["date", "area"], TOP_SCHEMA, "date", fan_in=compact_every)

    def process(self, updates: DataFrame, batch_id: int) -> None:
        """One batch's totals or increments, and the top lists of the days it touched."""
        # One action on the micro-batch (the upsert); the days it changed are the partitions it wrote.
        self.city_counts.upsert(updates, batch_id)
        days = self.city_counts.partitions_of_version(batch_id)
        if not days:
            return
        current = self.city_counts.read(batch_id, days)
        self.top.upsert(day_area_ad_top_n(day_area_ad_counts(current), self.top_n), batch_id)
        self.city_counts.fold(batch_id, days)
        self.top.fold(batch_id, days)


class WordCountTable:
    def __init__(self, spark: SparkSession, root: str, compact_every: int = FAN_IN):
        self.table = KeyedTable(spark, os.path.join(root, "word_count"), ["word"], WORD_SCHEMA, fan_in=compact_every)

    def process(self, updates: DataFrame, batch_id: int) -> None:
        self.table.upsert(updates, batch_id)
        self.table.fold(batch_id)


def running_state(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """What the state store of a running count holds: its key columns and ``n``, read from the checkpoint.

    Reads the last committed batch through Spark's state source, with the store's own partitions, so
    it works beside the stream and after a restart with any session settings.
    """
    state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    return state.select("key.*", F.element_at(F.map_values(F.from_json(F.to_json("value"), "map<string,long>")), 1).alias("n"))


def audit_totals(state: DataFrame, totals: DataFrame) -> DataFrame:
    """Keys whose count in the state store differs from the result table: the keys, ``in_state``, ``in_table``.

    One aggregate over both sides, so null keys meet like any other.
    """
    keys = [c for c in totals.columns if c != "n"]
    none = F.lit(None).cast("long")
    both = state.select(*keys, F.col("n").alias("in_state"), none.alias("in_table")).unionByName(
        totals.select(*keys, none.alias("in_state"), F.col("n").alias("in_table")))
    sums = both.groupBy(*keys).agg(F.sum("in_state").alias("in_state"), F.sum("in_table").alias("in_table"))
    return sums.where(~F.col("in_state").eqNullSafe(F.col("in_table")))
