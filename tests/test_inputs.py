"""Real inputs: tables as they come, source options, pruning at run time, one-call SQL, and failures between two writes."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clickpulse.operators import ads as AD
from clickpulse.operators import visits as V
from clickpulse.schemas import USER_VISIT_ACTION, rescue

SURVEYED = [f.name for f in USER_VISIT_ACTION.fields if f.name != "event_id"]


def raw_visits(spark, rows):
    """The 13 columns as text, as a file import gives them."""
    base = dict.fromkeys(SURVEYED) | {"date": "2019-11-26", "user_id": "1", "session_id": "s", "page_id": "3", "action_time": "2019-11-26 00:00:05",
                                      "click_category_id": "-1", "click_product_id": "-1", "city_id": "1"}
    return spark.createDataFrame([tuple({**base, **r}[c] for c in SURVEYED) for r in rows], ", ".join(f"`{c}` string" for c in SURVEYED))


def test_rescue_converts_the_surveyed_columns(spark):
    raw = raw_visits(spark, [{"page_id": "7"}, {"date": "2019-13-40", "user_id": "x1"}, {"action_time": "noon"}, {"page_id": None}, {"city_id": ""}])
    rows, bad = rescue(raw, USER_VISIT_ACTION, "visits", ("event_id",))
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in USER_VISIT_ACTION.fields if f.name != "event_id"]
    assert sorted((r.page_id or 0) for r in rows.collect()) == [0, 7]
    assert sorted(r.reason for r in bad.collect()) == ["action_time is no timestamp_ntz", "city_id is no bigint", "date is no date, user_id is no bigint"]
    assert bad.where("user_id = 'x1'").first().date == "2019-13-40"
    with pytest.raises(ValueError, match="missing column page_id"):
        rescue(raw.drop("page_id"), USER_VISIT_ACTION, "visits", ("event_id",))


def test_rescue_of_other_types(spark):
    from pyspark.sql import types as T

    want = T.StructType([T.StructField("a", T.LongType()), T.StructField("t", T.TimestampNTZType()), T.StructField("s", T.StringType())])
    df = spark.sql("SELECT * FROM VALUES (1.0D, TIMESTAMP '2020-01-01 00:00:00', 'x'), (1.5D, NULL, NULL), (CAST(NULL AS DOUBLE), NULL, 'y') AS v(a, t, s)")
    rows, bad = rescue(df, want)
    assert sorted((r.a, r.s) for r in rows.collect() if r.a) == [(1, "x")] and rows.count() == 2
    assert [r.reason for r in bad.collect()] == ["a is no bigint"]
    same, none = rescue(rows, want)
    assert same.count() == 2 and none.count() == 0 and none.columns == ["a", "t", "s", "reason"]


def test_command_line_on_untyped_tables(spark, tmp_root):
    from clickpulse.plans.cli import main

    path, out = os.path.join(tmp_root, "visits"), os.path.join(tmp_root, "out")
    raw_visits(spark, [{"page_id": str(p), "action_time": f"2019-11-26 00:00:{i:02d}"} for i, p in enumerate((1, 2, 1, 2))]).write.parquet(path)
    main(["jump", "--visits", path, "--target-page-flow", "1,2", "--out", out])
    assert [(r.jump, r.ratio) for r in spark.read.parquet(os.path.join(out, "jump_page_ratio")).collect()] == [("1-2", 1.0)]
    raw_visits(spark, [{"page_id": "two"}]).write.mode("append").parquet(path)
    with pytest.raises(ValueError, match="page_id is no bigint"):
        main(["jump", "--visits", path, "--target-page-flow", "1,2", "--out", out])
    main(["jump", "--visits", path, "--target-page-flow", "1,2", "--out", out + "2", "--rejects", os.path.join(tmp_root, "bad")])
    assert spark.read.parquet(os.path.join(tmp_root, "bad", "visits")).first().page_id == "two"
    assert spark.read.parquet(os.path.join(out + "2", "jump_page_ratio")).count() == 1


def test_kafka_options():
    from clickpulse.streaming.feed import kafka_options

    assert kafka_options("h:1", "ads") == {"kafka.bootstrap.servers": "h:1", "subscribe": "ads", "startingOffsets": "latest", "failOnDataLoss": "true"}
    full = kafka_options("h:1,h:2", "ads", "earliest", "g", 1000, 10, "5m", 64, False)
    assert full == {"kafka.bootstrap.servers": "h:1,h:2", "subscribe": "ads", "startingOffsets": "earliest", "failOnDataLoss": "false", "kafka.group.id": "g",
                    "maxOffsetsPerTrigger": "1000", "minOffsetsPerTrigger": "10", "maxTriggerDelay": "5m", "minPartitions": "64"}
    for wrong in ({"bootstrap_servers": "", "topic": "t"}, {"bootstrap_servers": "h", "topic": ""},
                  {"bootstrap_servers": "h", "topic": "t", "max_offsets_per_trigger": 5, "min_offsets_per_trigger": 6}, {"bootstrap_servers": "h", "topic": "t", "max_trigger_delay": "1m"}):
        with pytest.raises(ValueError):
            kafka_options(**wrong)


@pytest.mark.parametrize("k", [1, 2, 5, 60])
def test_sweep_equals_windows_of_every_row(spark, k):
    """Dense and sparse buckets, null ads: the sweep gives each window that holds a click, with its count."""
    import random
    from collections import Counter

    rng = random.Random(k)
    counts = Counter((rng.choice(["a", "b", None]), rng.randint(0, 30) * rng.choice([1, 1, 9])) for _ in range(200))
    df = spark.createDataFrame([(a, b, n) for (a, b), n in counts.items()], "adid string, bucket long, n long")
    want = Counter()
    for (a, b), n in counts.items():
        for s in range(b - k + 1, b + 1):
            want[a, s] += n
    got = AD.windows_of_buckets(df, k, 1)
    minute = F.timestamp_diff("MINUTE", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("window_start"))
    assert {(r.adid, r.m): r.n for r in got.select("adid", minute.alias("m"), "n").collect()} == dict(want)
    assert got.count() == len(want)


def test_filtered_visits_prune_at_run_time(spark, tmp_root):
    """On a table partitioned by a text date: the range and the chosen days prune folders, and a Bloom filter of the users reaches the scan."""
    path = os.path.join(tmp_root, "visits")
    rows = spark.range(4000).select((F.col("id") % 500).alias("user_id"), F.col("id").alias("event_id"),
                                    F.concat(F.lit("2019-11-"), F.lpad((F.col("id") % 20 + 1).cast("string"), 2, "0")).alias("date"))
    rows.write.partitionBy("date").parquet(path)
    users = os.path.join(tmp_root, "users")
    spark.range(500).select(F.col("id").alias("user_id"), (F.col("id") % 60).cast("int").alias("age")).write.parquet(users)
    visits, people = spark.read.schema("user_id long, event_id long, date string").parquet(path), spark.read.parquet(users)
    days = spark.createDataFrame([("2019-11-03", "sale"), ("2019-11-04", "sale")], "date string, kind string").where("kind = 'sale'")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        ranged = V.visit_filter(visits, people, "2019-11-02", "2019-11-05", 1, 3)
        plan = ranged._jdf.queryExecution().executedPlan().toString()
        assert "might_contain" in plan and any(x.startswith(": [isnotnull(date") and "2019-11-02" in x.split("]")[0] for x in plan.split("PartitionFilters"))
        want = rows.where("date between '2019-11-02' and '2019-11-05' and user_id % 60 between 1 and 3")
        assert sorted(r.event_id for r in ranged.collect()) == sorted(r.event_id for r in want.collect()) != []
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        chosen = V.visit_filter(visits, people, None, None, 1, 3, days)
        assert "dynamicpruning" in chosen._jdf.queryExecution().executedPlan().toString()
        assert {r.date for r in chosen.collect()} <= {"2019-11-03", "2019-11-04"} and chosen.count() > 0
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_share_in_one_sql_call(spark, fixture_visits, fixture_users, fixture_cities, fixture_products):
    from clickpulse.operators import area as A
    from clickpulse.plans.sql_jobs import register_views

    register_views(fixture_visits, fixture_users, fixture_cities, fixture_products)
    got = spark.sql("SELECT * FROM cp_city_click_share()")
    want = A.city_click_share(A.area_product_city_counts(A.area_city_clicks(fixture_visits, fixture_cities)))
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


CHILD = """
import os, sys
from clickpulse import get_spark, storage
from clickpulse.sinks.keyed import KeyedTable
from clickpulse.streaming.app import AdsApp

root, fault = sys.argv[1:3]
spark = get_spark(master="local[2]", shuffle_partitions=2, conf={"spark.sql.warehouse.dir": root + "-warehouse"})
app = AdsApp(spark, root, threshold=3)
batch = lambda lines: spark.createDataFrame([(x,) for x in lines], "value string")
app.process_lines(batch(BATCHES[0]), 0)
make, insert = storage.make_dirs, KeyedTable._insert

def cut_make(spark, path):
    if fault == "marker" and path.endswith("commits/1"):
        os._exit(9)
    make(spark, path)

def cut_insert(self, rows):
    if fault in self.path:
        os._exit(9)
    insert(self, rows)

storage.make_dirs, KeyedTable._insert = cut_make, cut_insert
app.process_lines(batch(BATCHES[1]), 1)
"""
BATCHES = [["1598500000000 A C1 u1 1", "1598500001000 A C1 u1 1", "1598500002000 A C1 u2 1"],
           ["1598500060000 A C2 u1 1", "1598500061000 A C1 u3 2", "bad line"],
           ["1598500120000 A C1 u1 1", "1598500121000 A C1 u2 1"]]


def tables_of(app):
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    return [key(x) for x in (app.guard.accepted(), app.guard.blocked(), app.guard.user_day_counts(), app.day_area.city_counts.read(),
                             app.day_area.top.read(), app.trend.minutes.read(), app.trend.trend.read(), app.rejects())]


@pytest.mark.parametrize("fault", ["marker", "guard/blocked", "trend/clock"])
def test_a_driver_lost_between_two_writes(spark, tmp_root, fault):
    """A process ends after accepted rows but before their marker, after counts but before blocks, after minutes but before the clock."""
    from clickpulse.streaming.app import AdsApp

    env = {**os.environ, "PYTHONPATH": str(Path(__file__).resolve().parent.parent)}
    code = f"BATCHES = {BATCHES!r}\n{CHILD}"
    root = os.path.join(tmp_root, "app")
    out = subprocess.run([sys.executable, "-c", code, root, fault], env=env, capture_output=True, text=True, timeout=300, cwd=tmp_root)
    assert out.returncode == 9, out.stderr[-2000:]
    batch = lambda b: spark.createDataFrame([(x,) for x in BATCHES[b]], "value string")
    again = AdsApp(spark, root, threshold=3)
    plain = AdsApp(spark, os.path.join(tmp_root, "plain"), threshold=3)
    plain.process_lines(batch(0), 0)
    for app in (plain, again):
        app.process_lines(batch(1), 1)
        app.process_lines(batch(2), 2)
    assert tables_of(again) == tables_of(plain)
    assert [r.userid for r in again.guard.blocked().collect()] == ["u1"]
