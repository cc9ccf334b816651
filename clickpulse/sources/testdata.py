"""Adapter from the driver's tables to the clickstream schemas.

The driver's tables hold no clickstream, so one is derived from ``events`` with
plain column expressions (no UDFs); the dimensions come from ``customer``,
``part`` and ``nation`` x ``region``. ``plans/oracle.py`` holds the same mapping
as DuckDB SQL, so both engines read identical inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.functions.timefmt import epoch_millis_of_ntz, utc_wallclock
from clickpulse.schemas import CITY_INFO, PRODUCT_INFO, USER_INFO, USER_VISIT_ACTION, check_schema
from clickpulse.sources.tables import read_table

N_CITIES = 25  # nation keys 0..24


def _k(props: Column) -> Column:
    """The integer in ``props`` (``{"k": 0..99}``)."""
    return F.regexp_extract(props, r"[0-9]+", 0).cast("int")


def visits_from_events(events: DataFrame) -> DataFrame:
    """``user_visit_action`` rows derived from ``events`` (one action per event)."""
    k = _k(F.col("props"))
    cat = (k % 20 + 1).cast("long")
    is_click = F.col("event_type") == "click"
    events = events.withColumn("ts", utc_wallclock(events.schema, "ts"))
    out = events.select(
        F.to_date("ts").alias("date"),
        F.col("user_id"),
        F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("session_id"),
        (k % 10 + 1).cast("long").alias("page_id"),
        F.col("ts").cast("timestamp_ntz").alias("action_time"),
        F.lit(None).cast("string").alias("search_keyword"),
        F.when(is_click, cat).otherwise(F.lit(-1).cast("long")).alias("click_category_id"),
        F.when(is_click, (k + 1).cast("long")).otherwise(F.lit(-1).cast("long")).alias("click_product_id"),
        F.when(
            F.col("event_type") == "purchase",
            F.concat_ws(",", cat.cast("string"), ((k + 7) % 20 + 1).cast("string")),
        ).alias("order_category_ids"),
        F.lit(None).cast("string").alias("order_product_ids"),
        F.when(
            F.col("event_type") == "signup",
            F.concat_ws(",", cat.cast("string"), ((k + 11) % 20 + 1).cast("string")),
        ).alias("pay_category_ids"),
        F.lit(None).cast("string").alias("pay_product_ids"),
        (F.col("event_id") % N_CITIES).cast("long").alias("city_id"),
        F.col("event_id"),
    )
    return check_schema(out, USER_VISIT_ACTION, "user_visit_action")


def users_from_customer(customer: DataFrame) -> DataFrame:
    out = customer.select(
        F.col("c_custkey").cast("long").alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (F.col("c_custkey") % 50 + 10).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.lit(None).cast("string").alias("gender"),
    )
    return check_schema(out, USER_INFO, "user_info")


def products_from_part(part: DataFrame) -> DataFrame:
    out = part.select(
        F.col("p_partkey").cast("long").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("extend_info"),
    )
    return check_schema(out, PRODUCT_INFO, "product_info")


def cities_from_nation(nation: DataFrame, region: DataFrame) -> DataFrame:
    out = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("long").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("area"),
    )
    return check_schema(out, CITY_INFO, "city_info")


def ads_lines_from_events(events: DataFrame, cities: DataFrame) -> DataFrame:
    """Ad-click wire lines ``"<epoch ms> <area> <city> <userid> <adid>"`` (column ``value``).

    Names are made space-free (``MIDDLE EAST`` -> ``MIDDLE_EAST``) because the
    wire format is split on single spaces. ``event_id`` is kept for batch splitting.
    """
    k = _k(F.col("props"))
    events = events.withColumn("ts", utc_wallclock(events.schema, "ts"))
    # cities is a 25-row dimension (nation x region): bounded, so broadcast it.
    joined = events.withColumn("city_id", (F.col("event_id") % N_CITIES).cast("long")).join(
        F.broadcast(cities), "city_id"
    )
    return joined.select(
        F.col("event_id"),
        F.concat_ws(
            " ",
            epoch_millis_of_ntz(F.col("ts")).cast("string"),
            F.regexp_replace("area", " ", "_"),
            F.regexp_replace("city_name", " ", "_"),
            F.col("user_id").cast("string"),
            (k % 6 + 1).cast("string"),
        ).alias("value"),
    )


class TestTables:
    """Lazily built adapter tables for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @property
    def visits(self) -> DataFrame:
        return visits_from_events(self.raw("events"))

    @property
    def users(self) -> DataFrame:
        return users_from_customer(self.raw("customer"))

    @property
    def products(self) -> DataFrame:
        return products_from_part(self.raw("part"))

    @property
    def cities(self) -> DataFrame:
        return cities_from_nation(self.raw("nation"), self.raw("region"))

    @property
    def ads_lines(self) -> DataFrame:
        return ads_lines_from_events(self.raw("events"), self.cities)

    @property
    def ads(self) -> DataFrame:
        """Parsed ad clicks (``event_id`` carried through for checks)."""
        from clickpulse.operators.ads import parse_ads_lines

        return parse_ads_lines(self.ads_lines)[0]
