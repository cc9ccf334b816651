"""The column helpers as SQL functions, for users who write Spark SQL.

``register_sql_functions(spark)`` creates session-scoped SQL functions with SQL
bodies (no Python at run time; Catalyst inlines them like any expression):

- ``cp_split_ids(ids)``        comma list -> array of ids, empty items dropped
- ``cp_pct1(n, total)``        one-decimal percentage, rounded half up
- ``cp_city_share(top, total)`` share text from the (<= 2) top cities, remainder always appended
- ``cp_pairs_json(items)``     array<struct<k, n>> -> ``[{"k":n},...]``
- ``cp_city_click_share()``    table function: (area, product_id, city_click_ratio) of the view
  ``area_city_clicks`` (area, city_name, click_product_id), in one call

The table function's body is the two-level aggregate (clicks per city, then one window per area and
product), which Catalyst plans with partial aggregation, so no group is ever gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from clickpulse.functions.share import OTHER_LABEL

_TOP = "ARRAY<STRUCT<city_name: STRING, n: BIGINT>>"


def sql_function_ddl(other_label: str = OTHER_LABEL) -> list[str]:
    pct = "floor(CAST(n AS DOUBLE) * 1000.0D / total + 0.5D) / 10.0D"
    return [
        """CREATE OR REPLACE TEMPORARY FUNCTION cp_split_ids(ids STRING) RETURNS ARRAY<STRING>
           RETURN filter(split(ids, ','), x -> length(trim(x)) > 0)""",
        f"""CREATE OR REPLACE TEMPORARY FUNCTION cp_pct1(n BIGINT, total BIGINT) RETURNS DOUBLE
           RETURN {pct}""",
        f"""CREATE OR REPLACE TEMPORARY FUNCTION cp_city_share(top {_TOP}, total BIGINT) RETURNS STRING
           RETURN array_join(concat(
               transform(top, x -> concat(x.city_name, ':',
                   CAST(floor(CAST(x.n AS DOUBLE) * 1000.0D / total + 0.5D) / 10.0D AS STRING), '%')),
               array(concat('{other_label}:', CAST(floor(aggregate(top, 100.0D,
                   (acc, x) -> acc - floor(CAST(x.n AS DOUBLE) * 1000.0D / total + 0.5D) / 10.0D)
                   * 10.0D + 0.5D) / 10.0D AS STRING), '%'))), ',')""",
        """CREATE OR REPLACE TEMPORARY FUNCTION cp_pairs_json(items ARRAY<STRUCT<k: STRING, n: BIGINT>>)
           RETURNS STRING RETURN to_json(transform(items, x -> map(x.k, x.n)))""",
    ]


SHARE_FUNCTION = """CREATE OR REPLACE TEMPORARY FUNCTION cp_city_click_share()
    RETURNS TABLE (area STRING, product_id BIGINT, city_click_ratio STRING)
    RETURN WITH per_city AS (
             SELECT area, click_product_id AS product_id, city_name, count(*) AS clicks FROM area_city_clicks GROUP BY ALL),
           placed AS (
             SELECT *, row_number() OVER (PARTITION BY area, product_id ORDER BY city_name IS NULL, clicks DESC, city_name) AS place,
                    sum(clicks) OVER (PARTITION BY area, product_id) AS whole FROM per_city),
           listed AS (
             SELECT area, product_id, max(whole) AS whole,
                    array_sort(collect_list(named_struct('place', place, 'city_name', city_name, 'n', clicks))
                               FILTER (WHERE city_name IS NOT NULL)) AS cities
             FROM placed WHERE place <= 2 GROUP BY area, product_id)
           SELECT area, product_id, cp_city_share(transform(cities, c -> named_struct('city_name', c.city_name, 'n', c.n)), whole) FROM listed"""


def register_share_function(spark: SparkSession) -> None:
    """``cp_city_click_share()``; the view ``area_city_clicks`` and the functions above must exist."""
    spark.sql(SHARE_FUNCTION)


def register_sql_functions(spark: SparkSession, other_label: str = OTHER_LABEL) -> None:
    for ddl in sql_function_ddl(other_label):
        spark.sql(ddl)
