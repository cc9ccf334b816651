from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpulse.sinks.jdbc import jdbc_append, jdbc_execute_rows, jdbc_read, replace_table
from clickpulse.sinks.keyed import KeyedTable, Run, SnapshotTable, tier
from clickpulse.sources.params import join_continued_lines, parse_conditions, read_properties_value

# In-process Derby (no server, no port): the JDBC path end to end.
DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _derby_url():
    return f"jdbc:derby:memory:cp{uuid.uuid4().hex[:8]};create=true"


def test_jdbc_batch_append_and_single_row(spark):
    url = _derby_url()
    df = spark.range(0, 1000, numPartitions=4).select(
        F.lit("task").alias("TASK_ID"), F.concat(F.col("id").cast("string"), F.lit("-x")).alias("JUMP"),
        (F.col("id") / 1000.0).alias("RATIO"),
    )
    create = dict(DERBY, createTableColumnTypes="TASK_ID VARCHAR(64), JUMP VARCHAR(64)")
    jdbc_append(df, url, "JUMP_PAGE_RATIO", create, batchsize=100, num_partitions=2)
    jdbc_execute_rows(spark, url, "JUMP_PAGE_RATIO", [("task", "extra", 0.5)], ["TASK_ID", "JUMP", "RATIO"], DERBY)
    back = jdbc_read(spark, url, "JUMP_PAGE_RATIO", DERBY)
    assert back.count() == 1001
    assert back.where(F.col("JUMP") == "extra").first().RATIO == 0.5


def test_replace_table(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    replace_table(spark.range(5), name)
    replace_table(spark.range(3), name)
    assert spark.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_keyed_table_upsert_and_replay(spark, tmp_root):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType()),
                           T.StructField("date", T.StringType())])
    t = KeyedTable(spark, os.path.join(tmp_root, "kt"), ["k"], schema, partition_col="date")
    assert t.read().count() == 0
    t.upsert(spark.createDataFrame([("a", 1, "d1"), ("b", 2, "d1")], schema), 0)
    t.upsert(spark.createDataFrame([("a", 5, "d1")], schema), 1)
    t.upsert(spark.createDataFrame([("a", 5, "d1")], schema), 1)  # replay
    assert sorted(map(tuple, t.read().collect())) == [("a", 5, "d1"), ("b", 2, "d1")]
    assert sorted(map(tuple, t.read(upto_version=0).collect())) == [("a", 1, "d1"), ("b", 2, "d1")]


def test_snapshot_replace_including_empty(spark, tmp_root):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    s = SnapshotTable(spark, os.path.join(tmp_root, "snap"), schema)
    s.replace(spark.createDataFrame([("a", 1), ("b", 2)], schema), 0)
    s.replace(spark.createDataFrame([("c", 3)], schema), 1)
    assert [tuple(r) for r in s.read().collect()] == [("c", 3)]
    s.replace(spark.createDataFrame([], schema), 2)
    assert s.read().count() == 0


def test_condition_params(spark, tmp_root):
    """Unquoted names, continued lines, empty and missing fields."""
    path = os.path.join(tmp_root, "conditions.properties")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write('condition.params.json={endAge: "31", targetPageFlow:"9,4",\\\n startDate:"2021-03-05", professionals:""}\n')
    r = read_properties_value(spark, path).first()
    assert (r.startDate, r.endAge, r.targetPageFlow, r.professionals) == ("2021-03-05", "31", "9,4", "")
    assert r.endDate is None and r.startAge is None and r.city is None
    assert join_continued_lines("a=1,\\\n 2") == join_continued_lines("a=1,\\\n2")
    strict = parse_conditions(spark.createDataFrame([('{"endAge": "8"}',)], "value string")).first()
    assert strict.endAge == "8"


def test_keyed_table_compaction_keeps_values_and_survives_replay(spark, tmp_root):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType()),
                           T.StructField("date", T.StringType())])
    path = os.path.join(tmp_root, "kc")
    t = KeyedTable(spark, path, ["date", "k"], schema, partition_col="date")
    batch = {b: spark.createDataFrame([("a", b, "d1"), (f"x{b}", 1, f"d{b % 2}")], schema) for b in range(5)}
    for b in range(4):
        t.upsert(batch[b], b)
    before = sorted(map(tuple, t.read().collect()))
    t.compact(3, ["d1"])  # folds versions <= 2 of day d1 into version 2
    assert sorted(map(tuple, t.read().collect())) == before
    assert sorted(r[0] for r in t.versions().where("date = 'd1'").select("_version").distinct().collect()) == [2, 3]
    t.upsert(batch[3], 3)  # replay of the current batch after the fold
    assert sorted(map(tuple, t.read().collect())) == before
    t.compact(4)  # whole table
    assert sorted(map(tuple, t.read().collect())) == before


def test_snapshot_keeps_two_versions(spark, tmp_root):
    schema = T.StructType([T.StructField("k", T.StringType())])
    s = SnapshotTable(spark, os.path.join(tmp_root, "sv"), schema)
    for b in range(5):
        s.replace(spark.createDataFrame([(f"k{b}",)], schema), b)
    versions = sorted(os.listdir(os.path.join(tmp_root, "sv")))
    assert [v for v in versions if v.startswith("_version=")] == ["_version=3", "_version=4"]
    assert [r.k for r in s.read().collect()] == ["k4"]


def test_keyed_table_ignores_what_a_cut_short_fold_left(spark, tmp_root, monkeypatch):
    """A fold that wrote its run but did not drop the old ones: readers count every batch once, and the next fold clears up."""
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType()), T.StructField("date", T.StringType())])
    t = KeyedTable(spark, os.path.join(tmp_root, "cut"), ["date", "k"], schema, "date", "sum", buckets=2, fan_in=2)
    for b in range(4):
        t.upsert(spark.createDataFrame([("a", 1, "d'1"), (None, 1, None)], schema), b)
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_drop", lambda self, runs: None)
        t.fold(4)
    assert len(t.runs()) == 10
    want = [("a", 4, "d'1"), (None, 4, None)]
    assert sorted(map(tuple, t.read().collect()), key=repr) == sorted(want, key=repr)
    assert {r.n for r in t.read(upto_version=1).collect()} == {2}
    t.upsert(spark.createDataFrame([("a", 1, "d'1")], schema), 4)
    t.upsert(spark.createDataFrame([("a", 1, "d'1")], schema), 5)
    t.compact(6)
    assert sorted((r.day, r.lo, r.hi) for r in t.runs()) == [("-", 0, 3), ("d'1", 0, 5)]
    assert sorted((r.n for r in t.read().collect())) == [4, 6]


def test_keyed_table_is_found_by_a_new_application(spark, tmp_root):
    """Another catalog finds the folder's runs and buckets again."""
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())])
    t = KeyedTable(spark, os.path.join(tmp_root, "again"), ["k"], schema, merge="sum", buckets=3)
    for b in range(3):
        t.upsert(spark.createDataFrame([("a", 2)], schema), b)
    spark.sql(f"DROP TABLE {t.name}")
    back = KeyedTable(spark, os.path.join(tmp_root, "again"), ["k"], schema, merge="sum", buckets=8)
    assert back.buckets == 3 and [tuple(r) for r in back.read().collect()] == [("a", 6)]


def test_tiers_rewrite_a_row_a_logarithmic_number_of_times():
    runs, merges = [], 0
    for b in range(4 ** 4):
        goal = tier(runs, 4)
        if goal:
            merges += sum(r.hi - r.lo + 1 for r in runs if r.lo >= goal.lo)
            runs = [r for r in runs if r.lo < goal.lo] + [goal]
        runs.append(Run("d", b, b, 0))
        assert [r.lo for r in runs] == sorted(r.lo for r in runs) and len(runs) <= 13
    assert merges <= 4 * 4 ** 4
