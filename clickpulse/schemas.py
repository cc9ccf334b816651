"""Declared schemas of the clickstream, its dimensions and the ad-click stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One row is one action (search | click | order | pay). "No click" is -1, not null;
# "no order" / "no pay" / "no search" are null. Id lists are comma-joined strings.
USER_VISIT_ACTION = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("action_time", T.TimestampNTZType()),
        T.StructField("search_keyword", T.StringType()),
        T.StructField("click_category_id", T.LongType()),
        T.StructField("click_product_id", T.LongType()),
        T.StructField("order_category_ids", T.StringType()),
        T.StructField("order_product_ids", T.StringType()),
        T.StructField("pay_category_ids", T.StringType()),
        T.StructField("pay_product_ids", T.StringType()),
        T.StructField("city_id", T.LongType()),
        # total-order tie-breaker after action_time (ties at 1 s resolution are common)
        T.StructField("event_id", T.LongType()),
    ]
)

USER_INFO = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("username", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("professional", T.StringType()),
        T.StructField("gender", T.StringType()),
    ]
)

PRODUCT_INFO = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("extend_info", T.StringType()),
    ]
)

CITY_INFO = T.StructType(
    [
        T.StructField("city_id", T.LongType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("area", T.StringType()),
    ]
)

# Parsed ad-click record: wire format "timestamp area city userid adid".
ADS_LOG = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("area", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("userid", T.StringType()),
        T.StructField("adid", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("date", T.StringType()),
    ]
)

ADS_REJECT = T.StructType(
    [
        T.StructField("line", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)


def check_schema(df: DataFrame, schema: T.StructType, name: str = "table") -> DataFrame:
    """Typed-scan check: every declared column exists with the declared type.

    Extra columns are allowed (and pruned later by Catalyst); missing or mistyped
    ones fail at analysis time, like a case-class ``.as[...]`` would.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in schema.fields:
        if f.name not in have:
            problems.append(f"missing column {f.name}")
        elif have[f.name] != f.dataType:
            problems.append(f"{f.name}: expected {f.dataType.simpleString()}, got {have[f.name].simpleString()}")
    if problems:
        raise ValueError(f"{name} does not match its schema: " + "; ".join(problems))
    return df.select(*[f.name for f in schema.fields])


def rescue(df: DataFrame, schema: T.StructType, name: str = "table", optional: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Typed scan of a table as it comes: ``(rows, bad)``.

    Each declared column is converted with ``try_cast`` (text dates and times, numbers in text,
    wider numbers). A row in which some value is lost by that goes to ``bad`` with its values as text and a
    ``reason`` that names the columns; nulls are no loss. A column that is missing fails, unless it is
    ``optional``: then it is left out. Other columns are dropped.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have and f.name not in optional]
    if missing:
        raise ValueError(f"{name} does not match its schema: missing column " + ", ".join(missing))
    fields = [f for f in schema.fields if f.name in have]
    same = [f for f in fields if have[f.name] == f.dataType]
    changed = [f for f in fields if have[f.name] != f.dataType]

    def typed(f: T.StructField) -> Column:
        return F.col(f.name) if f in same else _converted(F.col(f.name), have[f.name], f.dataType).alias(f.name)

    rows = df.select(*[typed(f) for f in fields])
    if not changed:
        return rows, df.select(*[F.col(f.name).cast("string").alias(f.name) for f in fields], F.lit("").alias("reason")).where(F.lit(False))
    lost = {f.name: F.col(f.name).isNotNull() & _converted(F.col(f.name), have[f.name], f.dataType).isNull() for f in changed}
    reason = F.concat_ws(", ", *[F.when(bad, F.lit(f"{c} is no {schema[c].dataType.simpleString()}")) for c, bad in lost.items()])
    marked = df.withColumn("_reason", reason)
    rows = marked.where("_reason = ''").select(*[typed(f) for f in fields])
    bad = marked.where("_reason <> ''").select(*[F.col(f.name).cast("string").alias(f.name) for f in fields], F.col("_reason").alias("reason"))
    return rows, bad


def _converted(c: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(have, T.TimestampType) and isinstance(want, T.TimestampNTZType):
        # A zoned instant is read as UTC, whatever the session's zone.
        return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    whole = isinstance(have, (T.DoubleType, T.FloatType, T.DecimalType)) and isinstance(want, (T.LongType, T.IntegerType))
    cast = c.try_cast(want)
    return F.when(cast == c, cast) if whole else cast  # 1.5 is no number of a page
