"""Top products per area with a per-city click share (job Q4).

Plan: clicks (``click_product_id > 0`` pushed to the scan) join the city
dimension (Spark chooses the join by its size), then one partial+final aggregate per
(area, product, city). Everything after that works on aggregated rows:
- one window per (area, product) ranks the cities and sums the product total;
  only the top 2 cities are collected (no per-group list larger than 2);
- rank: ``rank() <= n`` per area after joining ``product_info`` (unknown
  products are dropped *before* ranking), again trimmed by ``WindowGroupLimit``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse import constants as C
from clickpulse.functions.share import OTHER_LABEL, share_text


def area_city_clicks(visits: DataFrame, cities: DataFrame) -> DataFrame:
    """``area, city_name, click_product_id`` for every product click."""
    clicks = visits.where(F.col("click_product_id") > 0).select("city_id", "click_product_id")
    dim = cities.select("city_id", "city_name", "area")
    return clicks.join(dim, "city_id").select("area", "city_name", "click_product_id")


def area_product_city_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per (area, product, city)."""
    return clicks.groupBy("area", F.col("click_product_id").alias("product_id"), "city_name").agg(
        F.count(F.lit(1)).alias("n")
    )


def area_product_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per (area, product)."""
    return clicks.groupBy("area", F.col("click_product_id").alias("product_id")).agg(
        F.count(F.lit(1)).alias("product_count")
    )


def product_city_summary(city_counts: DataFrame, k: int = 2) -> DataFrame:
    """``area, product_id, total, top``: clicks of the product and its k top cities.

    One window per (area, product) over the aggregated counts gives both the
    city rank (ties by name; null cities sort last and are never shown) and the
    product total, so the whole job is one chain with no branch to recompute.
    Groups hold one row per city of the area: bounded by the city dimension.
    """
    w = Window.partitionBy("area", "product_id").orderBy(
        F.col("city_name").isNull(), F.desc("n"), F.asc("city_name")
    )
    whole = Window.partitionBy("area", "product_id")
    ranked = city_counts.select("*", F.row_number().over(w).alias("rn"), F.sum("n").over(whole).alias("total"))
    shown = F.when(F.col("city_name").isNotNull(), F.struct("rn", "city_name", "n"))
    return (
        ranked.where(F.col("rn") <= k)
        .groupBy("area", "product_id")
        .agg(F.max("total").cast("long").alias("total"), F.array_sort(F.collect_list(shown)).alias("top"))
    )


def city_click_share(city_counts: DataFrame, other_label: str = OTHER_LABEL) -> DataFrame:
    """``area, product_id, city_click_ratio`` from per-(area, product, city) counts.

    Top two cities by clicks (ties by name; null cities never shown but counted
    in the total), each as a one-decimal percentage, plus the remainder label.
    """
    summary = product_city_summary(city_counts, C.TOP_SHARE_CITIES)
    return summary.select(
        "area", "product_id", share_text(F.col("top"), F.col("total"), other_label).alias("city_click_ratio")
    )


def area_product_top_n(
    visits: DataFrame,
    cities: DataFrame,
    products: DataFrame,
    n: int = C.TOP_PRODUCTS,
    task_id: str | None = None,
    other_label: str = OTHER_LABEL,
) -> DataFrame:
    """Per area the products ranked <= n by clicks (``rank``: ties share a rank).

    Output: ``task_id, area, product_name, product_count, city_click_ratio``.
    """
    summary = product_city_summary(area_product_city_counts(area_city_clicks(visits, cities)), C.TOP_SHARE_CITIES)
    named = summary.join(products.select("product_id", "product_name"), "product_id")
    w = Window.partitionBy("area").orderBy(F.desc("total"))
    ranked = named.withColumn("rk", F.rank().over(w)).where(F.col("rk") <= n)
    if task_id is None:
        import uuid

        task_id = str(uuid.uuid4())
    return ranked.select(
        F.lit(task_id).alias("task_id"),
        "area",
        "product_name",
        F.col("total").alias("product_count"),
        share_text(F.col("top"), F.col("total"), other_label).alias("city_click_ratio"),
    )
