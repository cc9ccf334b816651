from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clickpulse.operators import jumps as J
from clickpulse.operators.slices import SLICE, not_after, session_cuts, with_slices
from clickpulse.schemas import USER_VISIT_ACTION
from clickpulse.session import ensure_checkpoint_dir
from tests.conftest import visit_row


def test_fixture_jump_ratio(fixture_visits):
    got = {r.jump: r.ratio for r in J.page_jump_ratio(fixture_visits, "1,2,3", "t").collect()}
    assert got == {"1-2": 1 / 3, "2-3": 1.0}


def test_fixture_counts(fixture_visits):
    pages = {r.page_id: r.n for r in J.single_page_count(fixture_visits, "1,2,3").collect()}
    assert pages == {1: 3, 2: 2}
    jumps = {r.jump: r.n for r in J.single_jump_count(fixture_visits, "1,2,3").collect()}
    assert jumps == {"1-2": 1, "2-3": 2}


def test_single_row_session_has_no_jump(spark):
    visits = spark.createDataFrame([visit_row(1, 1, "only", 1, 1)], USER_VISIT_ACTION)
    assert J.single_jump_count(visits, "1,2").count() == 0
    assert J.page_jump_ratio(visits, "1,2", "t").count() == 0


def test_missing_from_page_uses_denominator_one(spark):
    # page 5 never visited as a from-page of the flow "9,5": jump 9-5 occurs, page 9 counted
    rows = [visit_row(1, 1, "a", 9, 1), visit_row(2, 1, "a", 5, 2)]
    visits = spark.createDataFrame(rows, USER_VISIT_ACTION)
    got = {r.jump: r.ratio for r in J.page_jump_ratio(visits, "9,5", "t").collect()}
    assert got == {"9-5": 1.0}


def _brute_next(rows):
    by_session = {}
    for r in rows:
        by_session.setdefault(r[2], []).append(r)
    out = {}
    for items in by_session.values():
        items.sort(key=lambda r: (r[4], r[13]))
        for a, b in zip(items, items[1:] + [None]):
            out[a[13]] = None if b is None else b[3]
    return out


def test_hot_session_split_across_slices_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    eid = 0
    # one session holds most rows; times have many ties; a few small sessions around it
    for s, count in (("a", 5), ("hot", 600), ("m", 3), ("z", 40)):
        for _ in range(count):
            rows.append(visit_row(eid, 1, s, rnd.randint(1, 6), rnd.randint(0, 20)))
            eid += 1
    rnd.shuffle(rows)
    visits = spark.createDataFrame(rows, USER_VISIT_ACTION).repartition(7)
    want = _brute_next(rows)
    for slices in (1, 3, 16, 64, None):
        got = {r.event_id: r.next_page for r in J.session_next_page(visits, slices).collect()}
        assert got == want, slices


def test_hot_session_really_spans_many_slices(spark):
    """A session with nearly all rows is cut into even slices; sessions beside it keep one."""
    rows = [visit_row(i, 1, "hot", 1 + i % 3, i % 60, day=f"2019-11-{10 + i % 15}") for i in range(900)]
    rows += [visit_row(1000 + i, 1, f"s{i}", 1, i % 60) for i in range(40)]
    visits = spark.createDataFrame(rows, USER_VISIT_ACTION)
    cuts = session_cuts(visits, "session_id", "action_time", 16)
    sliced = with_slices(visits, "session_id", "action_time", cuts)
    sizes = {(r.session_id, r[SLICE]): r["count"] for r in sliced.groupBy("session_id", SLICE).count().collect()}
    hot = [n for (s, _), n in sizes.items() if s == "hot"]
    assert len(hot) >= 12 and max(hot) < 180 and sum(hot) == 900
    assert sum(n for (s, _), n in sizes.items() if s != "hot") == 40
    mixed = [r[0] for r in sliced.groupBy("session_id").agg((F.count_distinct(SLICE) > 1).alias("m")).where("m").select("session_id").collect()]
    assert len(mixed) <= 16


def test_building_the_plan_writes_nothing(spark, tmp_path):
    visits = spark.createDataFrame([visit_row(i, 1, "hot", 1 + i % 3, i % 60) for i in range(200)], USER_VISIT_ACTION)
    scratch = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = {str(p) for p in scratch.rglob("*")}
    out = J.page_jump_ratio(visits, "1,2,3", "t", slices=8)
    out.explain()
    assert out.count() == 2 and {str(p) for p in scratch.rglob("*")} == before


def test_cuts_of_empty_tables_and_other_time_types(spark):
    empty = spark.createDataFrame([], USER_VISIT_ACTION)
    assert session_cuts(empty, "session_id", "action_time", 8) == [] and J.session_next_page(empty, 8).count() == 0
    rows = [(f"s{i % 2}", i % 5, f"2019-11-26 00:00:{i:02d}", i) for i in range(40)]
    text = spark.createDataFrame(rows, "session_id string, page_id long, action_time string, event_id long")
    for kind in ("string", "timestamp", "timestamp_ntz", "date"):
        visits = text.withColumn("action_time", F.col("action_time").cast(kind))
        got = {r.event_id: r.next_page for r in J.session_next_page(visits, 8).collect()}
        assert got == {i: (i + 2) % 5 if i < 38 else None for i in range(40)}, kind
    nulls = text.withColumn("action_time", F.lit(None).cast("timestamp_ntz"))
    assert {r.event_id: r.next_page for r in J.session_next_page(nulls, 8).collect()} == got


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 100])
def test_binary_search_of_cuts(spark, n):
    cuts = [3 * i for i in range(n)]
    df = spark.range(-1, 3 * n + 2).withColumn("c", F.array(*[F.lit(x).cast("long") for x in cuts]))
    for r in df.select("id", not_after(F.col("c"), F.col("id"), n).alias("k")).collect():
        assert r.k == sum(c <= r.id for c in cuts)


def test_null_session_without_exchange_reuse_and_without_event_id(spark):
    rnd = random.Random(9)
    rows = [visit_row(i, 1, None if i % 3 else f"s{i % 5}", rnd.randint(1, 4), i % 60) for i in range(300)]
    visits = spark.createDataFrame(rows, USER_VISIT_ACTION)
    want = _brute_next(rows)
    for key in ("spark.sql.exchange.reuse", "spark.sql.execution.reuseSubquery", "spark.sql.adaptive.enabled"):
        spark.conf.set(key, "false")
        try:
            got = {r.event_id: r.next_page for r in J.session_next_page(visits, 16).collect()}
        finally:
            spark.conf.unset(key)
        assert got == want, key
    plain = [visit_row(0, 1, "s", 1 + i % 3, i % 60, day=f"2019-11-{10 + i // 60}") for i in range(300)]
    bare = spark.createDataFrame(plain, USER_VISIT_ACTION).drop("event_id")
    got = {r.jump: r.n for r in J.single_jump_count(bare, "1,2,3", 16).collect()}
    assert got == {"1-2": 100, "2-3": 100}
