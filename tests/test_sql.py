from __future__ import annotations

import pytest

from clickpulse.functions.sql import register_sql_functions
from clickpulse.plans.sql_jobs import area_product_top_n_sql, category_top_n_sql, register_views


@pytest.mark.parametrize(
    "top,total,expected",
    [
        ("array(struct('A', 5L), struct('B', 3L))", 10, "A:50.0%,B:30.0%,其他:20.0%"),
        ("array(struct('A', 1L), struct('B', 1L))", 3, "A:33.3%,B:33.3%,其他:33.4%"),
        ("array(struct('A', 15L), struct('B', 1L))", 16, "A:93.8%,B:6.3%,其他:-0.1%"),
        ("array(struct('A', 4L))", 4, "A:100.0%,其他:0.0%"),
    ],
)
def test_sql_city_share(spark, top, total, expected):
    register_sql_functions(spark)
    got = spark.sql(f"SELECT cp_city_share(CAST({top} AS ARRAY<STRUCT<city_name: STRING, n: BIGINT>>), "
                    f"{total}L) AS s").first().s
    assert got == expected


def test_sql_helpers(spark):
    register_sql_functions(spark)
    r = spark.sql("SELECT cp_split_ids('1,,2,') AS ids, cp_pct1(2, 3) AS p, "
                  "cp_pairs_json(array(named_struct('k', '3', 'n', 2L))) AS j").first()
    assert (r.ids, r.p, r.j) == (["1", "2"], 66.7, '[{"3":2}]')


def test_sql_jobs_on_fixture(spark, fixture_visits, fixture_users, fixture_cities, fixture_products):
    register_views(fixture_visits, fixture_users, fixture_cities, fixture_products)
    top = [tuple(r) for r in category_top_n_sql(spark, "t", None, None, 20, 50).collect()]
    assert top == [("t", "2", 2, 1, 1), ("t", "1", 2, 1, 0)]
    area = sorted((r.area, r.product_name, r.product_count, r.city_click_ratio)
                  for r in area_product_top_n_sql(spark, "t").collect())
    assert area == [("华东", "商品_11", 2, "上海:100.0%,其他:0.0%"),
                    ("华北", "商品_10", 3, "北京:66.7%,天津:33.3%,其他:0.0%")]
