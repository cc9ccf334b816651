"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables in ``sf_dir`` (through the adapter) and runs
over them whole. SQL twins live in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.operators import ads as AD
from clickpulse.operators import area as A
from clickpulse.operators import jumps as J
from clickpulse.operators import visits as V
from clickpulse.plans import params as P
from clickpulse.sources.testdata import TestTables

Query = Callable[[SparkSession, str], DataFrame]


def _filtered(t: TestTables) -> DataFrame:
    return V.visit_filter(t.visits, t.users, P.START_DATE, P.END_DATE, P.START_AGE, P.END_AGE)


def q_visit_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.visit_profile(TestTables(spark, sf_dir).visits)


def q_visit_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    fv = _filtered(TestTables(spark, sf_dir))
    return fv.select("user_id", "session_id", "page_id", F.col("date").cast("string").alias("date"), "event_id")


def q_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.category_counts(_filtered(TestTables(spark, sf_dir)))


def q_category_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.category_top_n(_filtered(TestTables(spark, sf_dir)), P.TOP_CATEGORIES, P.TASK_ID)


def q_category_session_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.category_session_counts(_filtered(TestTables(spark, sf_dir)))


def q_category_session_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    fv = _filtered(TestTables(spark, sf_dir))
    top = V.category_top_n(fv, P.TOP_CATEGORIES, P.TASK_ID)
    return V.category_session_top_n(fv, top, P.TOP_SESSIONS, P.TASK_ID)


def q_session_next_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    nx = J.session_next_page(TestTables(spark, sf_dir).visits)
    return nx.select("session_id", "event_id", "page_id", "next_page")


def q_single_page_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.single_page_count(TestTables(spark, sf_dir).visits, P.TARGET_PAGE_FLOW)


def q_single_jump_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.single_jump_count(TestTables(spark, sf_dir).visits, P.TARGET_PAGE_FLOW)


def q_page_jump_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.page_jump_ratio(TestTables(spark, sf_dir).visits, P.TARGET_PAGE_FLOW, P.TASK_ID)


def q_page_jump_ratio_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 with many more slices than sessions would need: most sessions span slices."""
    visits = TestTables(spark, sf_dir).visits
    return J.page_jump_ratio(visits, P.TARGET_PAGE_FLOW, P.TASK_ID, slices=P.JUMP_SLICES_CHECK)


def q_session_next_page_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    nx = J.session_next_page(TestTables(spark, sf_dir).visits, slices=P.JUMP_SLICES_CHECK)
    return nx.select("session_id", "event_id", "page_id", "next_page")


def _sql_views(spark: SparkSession, sf_dir: str) -> None:
    from clickpulse.plans.sql_jobs import register_views

    t = TestTables(spark, sf_dir)
    register_views(t.visits, t.users, t.cities, t.products)


def q_category_top10_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.plans.sql_jobs import category_top_n_sql

    _sql_views(spark, sf_dir)
    return category_top_n_sql(spark, P.TASK_ID, P.START_DATE, P.END_DATE, P.START_AGE, P.END_AGE, P.TOP_CATEGORIES)


def q_category_session_top10_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.plans.sql_jobs import category_session_top_n_sql, category_top_n_sql

    _sql_views(spark, sf_dir)
    top = category_top_n_sql(spark, P.TASK_ID, P.START_DATE, P.END_DATE, P.START_AGE, P.END_AGE, P.TOP_CATEGORIES)
    top.createOrReplaceTempView("category_top10")
    return category_session_top_n_sql(spark, P.TASK_ID, "category_top10", P.TOP_SESSIONS)


def q_page_jump_ratio_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.plans.sql_jobs import page_jump_ratio_sql

    _sql_views(spark, sf_dir)
    return page_jump_ratio_sql(spark, P.TASK_ID, P.TARGET_PAGE_FLOW)


def q_area_product_top3_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.plans.sql_jobs import area_product_top_n_sql

    _sql_views(spark, sf_dir)
    return area_product_top_n_sql(spark, P.TASK_ID, P.TOP_PRODUCTS)


def q_city_click_share_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The city share in one SQL call."""
    _sql_views(spark, sf_dir)
    return spark.sql("SELECT * FROM cp_city_click_share()")


def q_area_city_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = TestTables(spark, sf_dir)
    return A.area_city_clicks(t.visits, t.cities)


def q_area_product_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = TestTables(spark, sf_dir)
    return A.area_product_counts(A.area_city_clicks(t.visits, t.cities))


def q_city_click_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = TestTables(spark, sf_dir)
    return A.city_click_share(A.area_product_city_counts(A.area_city_clicks(t.visits, t.cities)))


def q_area_product_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = TestTables(spark, sf_dir)
    return A.area_product_top_n(t.visits, t.cities, t.products, P.TOP_PRODUCTS, P.TASK_ID)


def _ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TestTables(spark, sf_dir).ads


def _ads_batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    ads = _ads(spark, sf_dir)
    return ads.withColumn("batch_id", AD.batch_of_day(F.col("date"), P.GUARD_DAYS_PER_BATCH))


def q_ads_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ads(spark, sf_dir).select("event_id", "timestamp", "area", "city", "userid", "adid", "date")


def q_ads_user_day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AD.ads_user_day_counts(_ads(spark, sf_dir))


def q_ads_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AD.ads_blacklist(_ads(spark, sf_dir), P.GUARD_THRESHOLD)


def q_ads_blacklist_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    ads = _ads(spark, sf_dir)
    kept = AD.ads_blacklist_filter(ads, AD.ads_blacklist(ads, P.GUARD_THRESHOLD))
    return kept.select("event_id", "userid", "adid", "date")


def q_ads_guard_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AD.ads_guard_blocked(_ads_batched(spark, sf_dir), P.GUARD_THRESHOLD)


def q_ads_guard_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    acc = AD.ads_guard_accepted(_ads_batched(spark, sf_dir), P.GUARD_THRESHOLD)
    return acc.select("event_id", "batch_id", "userid", "adid", "date")


def q_ads_day_area_city_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AD.day_area_city_ad_counts(_ads(spark, sf_dir))


def q_ads_day_area_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AD.day_area_ad_counts(AD.day_area_city_ad_counts(_ads(spark, sf_dir)))


def q_ads_day_area_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AD.day_area_ad_top_n(AD.day_area_ad_counts(AD.day_area_city_ad_counts(_ads(spark, sf_dir))), P.TOP_ADS)


def q_ads_minute_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AD.ad_minute_rows(AD.ad_minute_counts(_ads(spark, sf_dir)))


def q_ads_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sw = AD.ad_sliding_counts(_ads(spark, sf_dir), P.SLIDING_LENGTH_MINUTES, P.SLIDING_SLIDE_MINUTES)
    return sw.select(
        "adid",
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        F.date_format("window_end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
        "n",
    )


def q_ads_last_hour_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AD.ad_recent_trend(_ads(spark, sf_dir), P.TREND_LENGTH_MINUTES)


def q_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AD.word_count(TestTables(spark, sf_dir).raw("documents"))


def _stream_queries() -> dict[str, Query]:
    from clickpulse.plans.streams import stream_queries

    return stream_queries()


def queries() -> dict[str, Query]:
    return {
        "ads_log_parse": q_ads_log_parse,
        "ads_user_day_counts": q_ads_user_day_counts,
        "ads_blacklist": q_ads_blacklist,
        "ads_blacklist_filter": q_ads_blacklist_filter,
        "ads_guard_blocked": q_ads_guard_blocked,
        "ads_guard_batches": q_ads_guard_batches,
        "ads_day_area_city_counts": q_ads_day_area_city_counts,
        "ads_day_area_counts": q_ads_day_area_counts,
        "ads_day_area_top3": q_ads_day_area_top3,
        "ads_minute_counts": q_ads_minute_counts,
        "ads_sliding_counts": q_ads_sliding_counts,
        "ads_last_hour_trend": q_ads_last_hour_trend,
        "word_count": q_word_count,
        **_stream_queries(),
        "session_next_page": q_session_next_page,
        "single_page_count": q_single_page_count,
        "single_jump_count": q_single_jump_count,
        "page_jump_ratio": q_page_jump_ratio,
        "page_jump_ratio_hot": q_page_jump_ratio_hot,
        "session_next_page_hot": q_session_next_page_hot,
        "area_city_clicks": q_area_city_clicks,
        "area_product_counts": q_area_product_counts,
        "city_click_share": q_city_click_share,
        "area_product_top3": q_area_product_top3,
        "category_top10_sql": q_category_top10_sql,
        "area_product_top3_sql": q_area_product_top3_sql,
        "category_session_top10_sql": q_category_session_top10_sql,
        "page_jump_ratio_sql": q_page_jump_ratio_sql,
        "city_click_share_sql": q_city_click_share_sql,
        "visit_profile": q_visit_profile,
        "visit_filter": q_visit_filter,
        "category_counts": q_category_counts,
        "category_top10": q_category_top10,
        "category_session_counts": q_category_session_counts,
        "category_session_top10": q_category_session_top10,
    }
