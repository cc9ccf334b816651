from __future__ import annotations

import pytest

from clickpulse.operators import area as A
from clickpulse.schemas import CITY_INFO, PRODUCT_INFO, USER_VISIT_ACTION
from tests.conftest import visit_row


def test_fixture_area_top3(fixture_visits, fixture_cities, fixture_products):
    got = sorted(
        (r.area, r.product_name, r.product_count, r.city_click_ratio)
        for r in A.area_product_top_n(fixture_visits, fixture_cities, fixture_products, 3, "t").collect()
    )
    assert got == [
        ("华东", "商品_11", 2, "上海:100.0%,其他:0.0%"),
        ("华北", "商品_10", 3, "北京:66.7%,天津:33.3%,其他:0.0%"),
    ]


@pytest.mark.parametrize(
    "counts,expected",
    [
        ({"A": 5, "B": 3, "C": 2}, "A:50.0%,B:30.0%,其他:20.0%"),
        ({"A": 1, "B": 1, "C": 1}, "A:33.3%,B:33.3%,其他:33.4%"),
        ({"A": 15, "B": 1}, "A:93.8%,B:6.3%,其他:-0.1%"),
        ({"A": 4}, "A:100.0%,其他:0.0%"),
    ],
)
def test_city_share_text(spark, counts, expected):
    rows = [("X", 1, city, n) for city, n in counts.items()]
    df = spark.createDataFrame(rows, "area string, product_id long, city_name string, n long")
    assert A.city_click_share(df).first().city_click_ratio == expected


def test_null_city_counts_in_total_only(spark):
    rows = [("X", 1, None, 5), ("X", 1, "A", 5)]
    df = spark.createDataFrame(rows, "area string, product_id long, city_name string, n long")
    assert A.city_click_share(df).first().city_click_ratio == "A:50.0%,其他:50.0%"


def test_rank_keeps_ties_and_drops_unknown_products_before_ranking(spark):
    cities = spark.createDataFrame([(1, "C1", "R")], CITY_INFO)
    # products 1..4 have clicks 6 (unknown product), 5, 5, 4, 3
    counts = {99: 6, 1: 5, 2: 5, 3: 4, 4: 3}
    rows, eid = [], 0
    for prod, n in counts.items():
        for _ in range(n):
            rows.append(visit_row(eid, 1, "s", 1, 1, 1, prod, city=1))
            eid += 1
    visits = spark.createDataFrame(rows, USER_VISIT_ACTION)
    products = spark.createDataFrame([(p, f"P{p}", "x") for p in (1, 2, 3, 4)], PRODUCT_INFO)
    got = sorted((r.product_name, r.product_count) for r in A.area_product_top_n(visits, cities, products, 3, "t").collect())
    assert got == [("P1", 5), ("P2", 5), ("P3", 4)]


def test_share_sums_to_hundred_property(spark):
    import random

    rnd = random.Random(3)
    rows = []
    for prod in range(30):
        for city in range(rnd.randint(1, 6)):
            rows.append(("X", prod, f"c{city}", rnd.randint(1, 50)))
    df = spark.createDataFrame(rows, "area string, product_id long, city_name string, n long")
    for r in A.city_click_share(df).collect():
        parts = [float(x.split(":")[1].rstrip("%")) for x in r.city_click_ratio.split(",")]
        assert abs(sum(parts) - 100.0) <= 0.15
        assert r.city_click_ratio.split(",")[-1].startswith("其他:")
