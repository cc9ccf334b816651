from __future__ import annotations

from pyspark.sql import functions as F

from clickpulse.operators import visits as V
from clickpulse.schemas import USER_VISIT_ACTION
from tests.conftest import visit_row


def test_filter_age_is_inclusive_range(fixture_visits, fixture_users):
    got = V.visit_filter(fixture_visits, fixture_users, "2019-11-01", "2019-12-11", 20, 50)
    assert sorted(r.event_id for r in got.collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_filter_empty_parameters_mean_no_predicate(fixture_visits, fixture_users):
    got = V.visit_filter(fixture_visits, fixture_users, "", None, "", None)
    assert got.count() == 8


def test_filter_date_range(fixture_visits, fixture_users):
    assert V.visit_filter(fixture_visits, fixture_users, "2019-11-27", None).count() == 0
    assert V.visit_filter(fixture_visits, fixture_users, None, "2019-11-26").count() == 8


def test_category_top_orders_by_click_order_pay(fixture_visits, fixture_users):
    fv = V.visit_filter(fixture_visits, fixture_users, None, None, 20, 50)
    got = [tuple(r) for r in V.category_top_n(fv, 10, "t").collect()]
    assert got == [("t", "2", 2, 1, 1), ("t", "1", 2, 1, 0)]


def test_category_sessions(fixture_visits, fixture_users):
    fv = V.visit_filter(fixture_visits, fixture_users, None, None, 20, 50)
    top = V.category_top_n(fv, 10, "t")
    got = sorted((r.category, r.session_id, r.n) for r in V.category_session_top_n(fv, top, 10, "t").collect())
    assert got == [(1, "s1", 2), (2, "s1", 1), (2, "s2", 1)]


def test_session_top_n_limits_and_breaks_ties_by_session(spark):
    rows = [visit_row(i, 1, f"s{i % 5}", 1, 1, 4, 1) for i in range(20)]
    visits = spark.createDataFrame(rows, USER_VISIT_ACTION)
    top = spark.createDataFrame([("4",)], "category string")
    got = [r.session_id for r in V.category_session_top_n(visits, top, 3, "t").orderBy("session_id").collect()]
    assert got == ["s0", "s1", "s2"]


def test_edge_id_lists_and_first_match(spark):
    rows = [
        visit_row(1, 1, "a", 1, 1, orders="1,,2"),
        visit_row(2, 1, "a", 1, 1, orders="1,2,"),
        visit_row(3, 1, "a", 1, 1, orders=""),
        visit_row(4, 1, "a", 1, 1, 5, 9, orders="7"),  # click wins over the order list
        visit_row(5, 1, "a", 1, 1),  # nothing to count
        visit_row(6, 1, "a", 1, 1, pays="3, 3"),
    ]
    visits = spark.createDataFrame(rows, USER_VISIT_ACTION)
    got = {r.category: (r.click, r.order, r.pay) for r in V.category_counts(visits).collect()}
    assert got == {"1": (0, 2, 0), "2": (0, 2, 0), "5": (1, 0, 0), "3": (0, 0, 1), " 3": (0, 0, 1)}


def test_category_counts_plan_is_partial_aggregate(fixture_visits):
    plan = V.category_counts(fixture_visits)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_profile(fixture_visits):
    r = V.visit_profile(fixture_visits).first()
    assert r.rows == 8 and r.first_action == "2019-11-26 00:00:01" and r.last_date == "2019-11-26"


def test_check_schema_rejects_wrong_types(spark):
    import pytest

    from clickpulse.schemas import check_schema

    df = spark.createDataFrame([(1,)], "date long")
    with pytest.raises(ValueError):
        check_schema(df, USER_VISIT_ACTION)
    ok = spark.createDataFrame([], USER_VISIT_ACTION).withColumn("extra", F.lit(1))
    assert check_schema(ok, USER_VISIT_ACTION).columns == [f.name for f in USER_VISIT_ACTION.fields]
