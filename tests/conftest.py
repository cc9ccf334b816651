from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clickpulse.schemas import CITY_INFO, PRODUCT_INFO, USER_INFO, USER_VISIT_ACTION  # noqa: E402
from clickpulse.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark(app="clickpulse-tests", master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="clickpulse-test-")


def visit_row(event_id, user, session, page, second, click_cat=-1, click_prod=-1, orders=None, pays=None,
              city=1, search=None, day="2019-11-26"):
    d = dt.date.fromisoformat(day)
    return (
        d, user, session, page, dt.datetime(d.year, d.month, d.day, 0, 0, second), search,
        click_cat, click_prod, orders, None, pays, None, city, event_id,
    )


@pytest.fixture()
def fixture_visits(spark):
    """FIXTURES.md 4.1."""
    rows = [
        visit_row(1, 1, "s1", 1, 1, 1, 10, city=1),
        visit_row(2, 1, "s1", 2, 2, 1, 10, city=1),
        visit_row(3, 1, "s1", 3, 2, orders="1,2", city=7),
        visit_row(4, 1, "s1", 2, 4, 2, 11, city=2),
        visit_row(5, 1, "s1", 3, 5, pays="2", city=7),
        visit_row(6, 2, "s2", 1, 3, 2, 10, city=7),
        visit_row(7, 2, "s2", 3, 6, city=1, search="手机"),
        visit_row(8, 3, "s3", 1, 7, 3, 11, city=2),
    ]
    return spark.createDataFrame(rows, USER_VISIT_ACTION)


@pytest.fixture()
def fixture_users(spark):
    return spark.createDataFrame(
        [(1, "u1", "u1", 25, "学生", "男"), (2, "u2", "u2", 50, "老师", "女"), (3, "u3", "u3", 60, "经理", "男")],
        USER_INFO,
    )


@pytest.fixture()
def fixture_cities(spark):
    return spark.createDataFrame([(1, "北京", "华北"), (7, "天津", "华北"), (2, "上海", "华东")], CITY_INFO)


@pytest.fixture()
def fixture_products(spark):
    return spark.createDataFrame([(10, "商品_10", "自营"), (11, "商品_11", "第三方")], PRODUCT_INFO)
