"""Clickstream filters and category rankings (jobs Q1, Q2).

Plans (checked with ``explain``):
- ``category_counts``: one scan with pruned columns -> ``inline`` of the action
  array -> partial + final hash aggregate on ``category`` (map-side combine, so a
  hot category costs one row per map task).
- ``category_top_n``: ``TakeOrderedAndProject`` (per-task top-n, then merge).
- ``category_session_top_n``: broadcast semi-join with the bounded top-n list,
  partial aggregate on (category, session), ``row_number`` window whose
  ``WindowGroupLimit`` trims every map task to n rows per category before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse import constants as C
from clickpulse.functions.idlists import split_ids


def _present(v) -> bool:
    return v is not None and str(v).strip() != ""


def visit_filter(
    visits: DataFrame,
    users: DataFrame,
    start_date: str | None = None,
    end_date: str | None = None,
    start_age: int | str | None = None,
    end_age: int | str | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """Visits of users in an optional date range and age range (all bounds inclusive).

    ``None`` or ``""`` means "no predicate". Joined to ``users`` on ``user_id`` with
    inner-join semantics (a duplicated user id duplicates its visits), keeping only
    the visit columns. Both ranges are pushed to their scans: a ``date`` of text is compared as text
    (``yyyy-MM-dd`` keeps its order), never converted row by row, so a table partitioned by it is pruned.
    ``days`` (date, few rows, of the same type): only visits on these days; on a table partitioned by date
    Spark prunes the folders with their dates at run time, as it may filter the visits by a Bloom filter of
    the chosen users before the join.
    """
    text = dict(visits.dtypes)["date"] == "string"

    def bound(day: object) -> Column:
        return F.lit(str(day).strip()) if text else F.to_date(F.lit(str(day)))

    vpreds: list[Column] = []
    if _present(start_date):
        vpreds.append(F.col("date") >= bound(start_date))
    if _present(end_date):
        vpreds.append(F.col("date") <= bound(end_date))
    upreds: list[Column] = []
    if _present(start_age):
        upreds.append(F.col("age") >= F.lit(int(start_age)))
    if _present(end_age):
        upreds.append(F.col("age") <= F.lit(int(end_age)))
    v = visits.where(reduce(lambda a, b: a & b, vpreds)) if vpreds else visits
    u = users.select("user_id", "age")
    u = u.where(reduce(lambda a, b: a & b, upreds)) if upreds else u
    if days is not None:
        v = v.join(days.select("date").distinct(), "date", "left_semi")
    # Spark chooses the join by the users' size; in a shuffle join AQE splits a hot user's partition.
    return v.join(u.select("user_id"), "user_id", "inner").select(*visits.columns)


def action_categories(visits: DataFrame) -> DataFrame:
    """One row per counted (action, category): first match of click, else order list, else pay list."""
    click = F.array(F.struct(F.lit("click").alias("action"), F.col("click_category_id").cast("string").alias("category")))

    def listed(action: str, ids: str) -> Column:
        return F.transform(split_ids(F.col(ids)), lambda c: F.struct(F.lit(action).alias("action"), c.alias("category")))

    acts = (
        F.when(F.col("click_category_id") != C.NO_CLICK, click)
        .when(F.col("order_category_ids").isNotNull(), listed("order", "order_category_ids"))
        .when(F.col("pay_category_ids").isNotNull(), listed("pay", "pay_category_ids"))
    )
    return visits.select(F.inline(acts))


def category_counts(visits: DataFrame) -> DataFrame:
    """(category string, click, order, pay) counts; missing actions count 0."""
    return (
        action_categories(visits)
        .groupBy("category")
        .agg(
            F.count_if(F.col("action") == "click").alias("click"),
            F.count_if(F.col("action") == "order").alias("order"),
            F.count_if(F.col("action") == "pay").alias("pay"),
        )
    )


def category_top_n(visits: DataFrame, n: int = C.TOP_CATEGORIES, task_id: str | None = None) -> DataFrame:
    """Top-n categories by clicks, then orders, then payments (desc); ties by category."""
    ranked = category_counts(visits).orderBy(
        F.desc("click"), F.desc("order"), F.desc("pay"), F.asc("category")
    ).limit(n)
    return _with_task(ranked, task_id).select("task_id", "category", "click", "order", "pay")


def category_session_counts(visits: DataFrame) -> DataFrame:
    """Clicks per (category, session)."""
    return (
        visits.where(F.col("click_category_id") != C.NO_CLICK)
        .groupBy(F.col("click_category_id").alias("category"), "session_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def category_session_top_n(
    visits: DataFrame, top_categories: DataFrame, n: int = C.TOP_SESSIONS, task_id: str | None = None
) -> DataFrame:
    """For each category of ``top_categories`` the n sessions with most clicks (ties by session id)."""
    # top_categories holds at most a top-n list: bounded by construction, safe to broadcast.
    top = F.broadcast(top_categories.select(F.col("category").cast("long").alias("click_category_id")).distinct())
    clicks = visits.select("click_category_id", "session_id").join(top, "click_category_id", "left_semi")
    counts = category_session_counts(clicks)
    w = Window.partitionBy("category").orderBy(F.desc("n"), F.asc("session_id"))
    best = counts.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n).drop("rn")
    return _with_task(best, task_id).select("task_id", "category", "session_id", "n")


def visit_profile(visits: DataFrame) -> DataFrame:
    """Dataset profile as one row: row count, first/last action time, first/last day (one partial aggregate)."""
    return visits.agg(
        F.count(F.lit(1)).alias("rows"),
        F.date_format(F.min("action_time"), "yyyy-MM-dd HH:mm:ss").alias("first_action"),
        F.date_format(F.max("action_time"), "yyyy-MM-dd HH:mm:ss").alias("last_action"),
        F.min("date").cast("string").alias("first_date"),
        F.max("date").cast("string").alias("last_date"),
    )


def _with_task(df: DataFrame, task_id: str | None) -> DataFrame:
    if task_id is None:
        import uuid

        task_id = str(uuid.uuid4())  # one id per run, not per row
    return df.withColumn("task_id", F.lit(task_id))
