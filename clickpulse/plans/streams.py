"""Registered streaming queries.

Each one replays data Spark derives from the given tables as micro-batches
(``ReplayFeed``: append a batch to an inbox folder, run the query with
``availableNow`` on the same checkpoint), writes through its ``foreachBatch``
sink and returns the result table. Scratch folders live under the session's
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.functions.timefmt import day_key, minute_text, ntz_of_epoch_millis
from clickpulse.operators.ads import batch_of_day, parse_ads_lines
from clickpulse.plans import params as P
from clickpulse.session import scratch_dir, stream_session
from clickpulse.sources.testdata import TestTables
from clickpulse.streaming.app import AdsApp
from clickpulse.streaming.counts import DayAreaAdTables, WordCountTable, day_area_city_counts_stream, word_count_stream
from clickpulse.streaming.feed import ReplayFeed, start_foreach_batch
from clickpulse.streaming.guard import AdClickGuard
from clickpulse.streaming.trend import SlidingTables, TrendTables

LINE_FEED_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.StringType())])
DOC_FEED_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
WORD_COUNT_BATCHES = 3


def ads_feed(spark: SparkSession, sf_dir: str, days_per_batch: int = P.GUARD_DAYS_PER_BATCH) -> DataFrame:
    """Ad-click lines with their micro-batch number (consecutive day ranges)."""
    lines = TestTables(spark, sf_dir).ads_lines
    ms = F.try_element_at(F.split("value", " "), F.lit(1)).try_cast("bigint")
    return lines.withColumn("batch", batch_of_day(day_key(ntz_of_epoch_millis(ms)), days_per_batch))


def run_replay(
    spark: SparkSession,
    name: str,
    feed_df: DataFrame,
    schema: T.StructType,
    build: Callable[[DataFrame], DataFrame],
    process: Callable[[DataFrame, int], None],
    output_mode: str = "append",
    root: str | None = None,
) -> str:
    """Replay ``feed_df`` through ``build`` -> ``process``; ``spark`` is the session the stream runs in."""
    root = root or scratch_dir(spark, name)
    feed = ReplayFeed(spark, root)
    checkpoint = os.path.join(root, "checkpoint")

    def start():
        # One long-running query for the whole replay (no availableNow restarts per batch).
        return start_foreach_batch(build(feed.stream(schema)), process, checkpoint, output_mode, available_now=False)

    feed.run(feed_df, "batch", start, continuous=True)
    return root


def newest_first(feed: DataFrame) -> DataFrame:
    """The same feed with its batches in reverse order, so every batch but the first is late."""
    return feed.withColumn("batch", -F.col("batch"))


def _parsed(stream: DataFrame) -> DataFrame:
    return parse_ads_lines(stream)[0]


# Each runner streams in its own session (``stream_session``): the state-partition count is
# the cluster's parallelism, whatever the caller's ``spark.sql.shuffle.partitions`` is.

def run_guard(spark: SparkSession, sf_dir: str, threshold: int = P.GUARD_THRESHOLD) -> AdClickGuard:
    ss = stream_session(spark)
    root = scratch_dir(ss, "guard")
    guard = AdClickGuard(ss, os.path.join(root, "tables"), threshold)
    run_replay(ss, "guard", ads_feed(ss, sf_dir), LINE_FEED_SCHEMA, _parsed, guard.process, root=root)
    return guard


def run_day_area(spark: SparkSession, sf_dir: str) -> DayAreaAdTables:
    ss = stream_session(spark)
    root = scratch_dir(ss, "day-area")
    tables = DayAreaAdTables(ss, os.path.join(root, "tables"), P.TOP_ADS)
    run_replay(
        ss, "day-area", ads_feed(ss, sf_dir), LINE_FEED_SCHEMA,
        lambda s: day_area_city_counts_stream(_parsed(s)), tables.process, "update", root=root,
    )
    return tables


def run_trend(spark: SparkSession, sf_dir: str) -> TrendTables:
    ss = stream_session(spark)
    root = scratch_dir(ss, "trend")
    tables = TrendTables(ss, os.path.join(root, "tables"), P.TREND_LENGTH_MINUTES)
    run_replay(
        ss, "trend", newest_first(ads_feed(ss, sf_dir)), LINE_FEED_SCHEMA,
        lambda s: _parsed(s).select("adid", "ts"), tables.add_rows, root=root,
    )
    return tables


def run_sliding(spark: SparkSession, sf_dir: str) -> SlidingTables:
    ss = stream_session(spark)
    root = scratch_dir(ss, "sliding")
    tables = SlidingTables(ss, os.path.join(root, "tables"), P.SLIDING_LENGTH_MINUTES, P.SLIDING_SLIDE_MINUTES)
    run_replay(
        ss, "sliding", newest_first(ads_feed(ss, sf_dir)), LINE_FEED_SCHEMA,
        lambda s: _parsed(s).select("adid", "ts"), tables.add_rows, root=root,
    )
    return tables


def run_word_count(spark: SparkSession, sf_dir: str) -> WordCountTable:
    ss = stream_session(spark)
    root = scratch_dir(ss, "words")
    table = WordCountTable(ss, os.path.join(root, "tables"))
    docs = TestTables(ss, sf_dir).raw("documents").select("doc_id", "text")
    top = docs.agg(F.max("doc_id")).first()[0] or 0  # one number: sizes the doc-id ranges
    feed = docs.withColumn("batch", F.floor(F.col("doc_id") * WORD_COUNT_BATCHES / F.lit(top + 1)).cast("long"))
    run_replay(ss, "words", feed, DOC_FEED_SCHEMA, word_count_stream, table.process, "update", root=root)
    return table


def run_app(spark: SparkSession, sf_dir: str, fanout: str = "stream") -> AdsApp:
    """The whole ad app: guard over the replayed feed, then the fan-out (queries or inline)."""
    ss = stream_session(spark)
    root = scratch_dir(ss, "app")
    app = AdsApp(ss, os.path.join(root, "app"), P.GUARD_THRESHOLD, P.TOP_ADS, P.TREND_LENGTH_MINUTES, fanout=fanout)
    feed = ReplayFeed(ss, root)
    feed.run(ads_feed(ss, sf_dir), "batch", lambda: app.start_guard(feed.stream(LINE_FEED_SCHEMA), available_now=False),
             continuous=True)
    for q in app.start_downstream():
        q.awaitTermination()
    return app


# registered queries -------------------------------------------------------------

def q_ads_guard_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_guard(spark, sf_dir).accepted().select("event_id", "userid", "adid", "date")


def q_ads_guard_stream_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_guard(spark, sf_dir).blocked().select("userid")


def q_stream_day_area_city_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_day_area(spark, sf_dir).city_counts.read()


def q_stream_day_area_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_day_area(spark, sf_dir).top.read()


def q_stream_ads_minute_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = run_trend(spark, sf_dir).minutes.read()
    return m.select("adid", minute_text(F.col("minute")).alias("minute"), "n")


def q_stream_ads_last_hour_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_trend(spark, sf_dir).trend.read()


def q_stream_ads_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = run_sliding(spark, sf_dir).read()
    return c.select(
        "adid",
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        F.date_format("window_end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
        "n",
    )


def q_stream_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_word_count(spark, sf_dir).table.read()


def q_ads_app_day_area_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_app(spark, sf_dir).day_area.top.read()


def q_ads_app_last_hour_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_app(spark, sf_dir).trend.trend.read()


def q_ads_app_inline_day_area_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_app(spark, sf_dir, "inline").day_area.top.read()


def q_ads_app_inline_last_hour_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_app(spark, sf_dir, "inline").trend.trend.read()


def stream_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "ads_guard_stream": q_ads_guard_stream,
        "ads_guard_stream_blocked": q_ads_guard_stream_blocked,
        "stream_day_area_city_ads": q_stream_day_area_city_ads,
        "stream_day_area_top3": q_stream_day_area_top3,
        "stream_ads_minute_counts": q_stream_ads_minute_counts,
        "stream_ads_last_hour_trend": q_stream_ads_last_hour_trend,
        "stream_ads_sliding_counts": q_stream_ads_sliding_counts,
        "stream_word_count": q_stream_word_count,
        "ads_app_day_area_top3": q_ads_app_day_area_top3,
        "ads_app_last_hour_trend": q_ads_app_last_hour_trend,
        "ads_app_inline_day_area_top3": q_ads_app_inline_day_area_top3,
        "ads_app_inline_last_hour_trend": q_ads_app_inline_last_hour_trend,
    }
