from __future__ import annotations

import os
import time

from pyspark.sql import functions as F

from clickpulse.operators.ads import ad_sliding_counts, parse_ads_lines
from clickpulse.plans.streams import LINE_FEED_SCHEMA, run_replay
from clickpulse.streaming.counts import DayAreaAdTables, day_area_city_counts_stream
from clickpulse.streaming.guard import AdClickGuard
from clickpulse.streaming.trend import SlidingTables, TrendTables


def _ads_df(spark, rows):
    """rows: (userid, adid) on 2020-08-27; returns parsed ad rows with event ids."""
    lines = [(i, f"{1598500000000 + i * 1000} A C {u} {ad}") for i, (u, ad) in enumerate(rows)]
    df = spark.createDataFrame(lines, "event_id long, value string")
    return parse_ads_lines(df)[0]


def test_guard_batches_and_replay(spark, tmp_root):
    """FIXTURES.md 4.4 through the foreachBatch step; replaying batch 1 changes nothing."""
    guard = AdClickGuard(spark, tmp_root, threshold=3)
    batches = [[("u1", "1"), ("u1", "1"), ("u2", "1")], [("u1", "1"), ("u1", "1"), ("u1", "2")], [("u1", "2"), ("u2", "1")]]
    dfs = [_ads_df(spark, b) for b in batches]
    guard.process(dfs[0], 0)
    guard.process(dfs[1], 1)
    guard.process(dfs[1], 1)  # replay
    guard.process(dfs[2], 2)
    acc = {b: n for b, n in guard.accepted().groupBy("batch_id").count().collect()}
    assert acc == {0: 3, 1: 3, 2: 1}
    assert [tuple(r) for r in guard.blocked().collect()] == [("u1", 1)]
    counts = {(r.userid, r.adid): r.n for r in guard.user_day_counts().collect()}
    assert counts == {("u1", "1"): 4, ("u1", "2"): 1, ("u2", "1"): 2}


def test_guard_keeps_null_user(spark, tmp_root):
    guard = AdClickGuard(spark, tmp_root, threshold=1)
    df = parse_ads_lines(spark.createDataFrame([(1, "1598500000000 A C u1 1")], "event_id long, value string"))[0]
    guard.process(df, 0)
    nul = df.withColumn("userid", F.lit(None).cast("string"))
    guard.process(nul, 1)
    assert guard.accepted().where(F.col("batch_id") == 1).count() == 1


def _feed(spark, minutes_by_batch):
    rows = []
    eid = 0
    for b, items in enumerate(minutes_by_batch):
        for sec, ad in items:
            rows.append((eid, f"{1598500000000 + sec * 1000} A C u{eid} {ad}", b))
            eid += 1
    return spark.createDataFrame(rows, "event_id long, value string, batch long")


def test_day_area_stream_running_counts_across_restarts(spark, tmp_root):
    feed = _feed(spark, [[(0, "1"), (1, "1")], [(2, "1"), (3, "2")], [(4, "2")]])
    tables = DayAreaAdTables(spark, os.path.join(tmp_root, "t"), 3)
    run_replay(spark, "t", feed, LINE_FEED_SCHEMA, lambda s: day_area_city_counts_stream(parse_ads_lines(s)[0]),
               tables.process, "update", root=tmp_root)
    got = {r.adid: r.n for r in tables.city_counts.read().collect()}
    assert got == {"1": 3, "2": 2}
    assert tables.top.read().first().top_json == '[{"1":3},{"2":2}]'


def test_trend_stream_adds_one_minute_split_over_batches(spark, tmp_root):
    # 03:46:40 and 03:46:50 are one minute, in two micro-batches
    feed = _feed(spark, [[(0, "3")], [(10, "3"), (25, "2")]])
    tables = TrendTables(spark, os.path.join(tmp_root, "t"), 60)
    run_replay(spark, "t", feed, LINE_FEED_SCHEMA, lambda s: parse_ads_lines(s)[0], tables.add_rows, root=tmp_root)
    got = {r.adid: r.trend_json for r in tables.trend.read().collect()}
    assert got == {"3": '[{"03:46":2}]', "2": '[{"03:47":1}]'}


def test_late_and_future_rows(spark, tmp_root):
    """Rows hours late are counted in both tables; a line dated 400 days ahead does not move the clock."""
    ahead = int(time.time()) - 1598500000 + 400 * 86400
    feed = _feed(spark, [[(0, "1")], [(7200, "1")], [(5, "1"), (ahead, "9")], [(7260, "1"), (3, "2")], [(-90000, "1")]])
    trend = TrendTables(spark, os.path.join(tmp_root, "t"), 60)
    sliding = SlidingTables(spark, os.path.join(tmp_root, "s"), 3, 1)
    run_replay(spark, "t", feed, LINE_FEED_SCHEMA, lambda s: parse_ads_lines(s)[0], trend.add_rows, root=os.path.join(tmp_root, "f1"))
    run_replay(spark, "s", feed, LINE_FEED_SCHEMA, lambda s: parse_ads_lines(s)[0], sliding.add_rows, root=os.path.join(tmp_root, "f2"))
    assert trend.minutes.read().agg(F.sum("n")).first()[0] == 7
    assert {r.adid: r.trend_json for r in trend.trend.read().collect()} == {"1": '[{"05:46":1},{"05:47":1}]'}
    lines = feed.select("event_id", "value")
    want = ad_sliding_counts(parse_ads_lines(lines)[0], 3, 1)
    assert sorted(map(tuple, sliding.read().collect())) == sorted(map(tuple, want.collect()))
    trend.add_rows(parse_ads_lines(feed.where("batch = 3").select("event_id", "value"))[0], 3)  # a replay changes nothing older
    assert trend.minutes.read(upto_version=3).agg(F.sum("n")).first()[0] == 6


def test_null_keys_keep_their_totals(spark, tmp_root):
    table = SlidingTables(spark, os.path.join(tmp_root, "n"), 3, 1)
    rows = spark.createDataFrame([(None, "2020-01-01 00:00:05")], "adid string, t string").select("adid", F.col("t").cast("timestamp_ntz").alias("ts"))
    for n in range(3):
        table.add_rows(rows, n)
    assert table.buckets.read().first().n == 3


def test_restart_resumes_from_checkpoint(spark, tmp_root):
    """Two separate feed runs on one checkpoint: the second only sees new files."""
    tables = DayAreaAdTables(spark, os.path.join(tmp_root, "t"), 3)
    build = lambda s: day_area_city_counts_stream(parse_ads_lines(s)[0])
    run_replay(spark, "t", _feed(spark, [[(0, "1")]]), LINE_FEED_SCHEMA, build, tables.process, "update", root=tmp_root)
    run_replay(spark, "t", _feed(spark, [[(5, "1")]]), LINE_FEED_SCHEMA, build, tables.process, "update", root=tmp_root)
    assert tables.city_counts.read().first().n == 2


def test_guard_compaction_keeps_counts_and_blocks(spark, tmp_root):
    """Fold every 2 batches; results equal the un-compacted guard, replays included."""
    import random

    rnd = random.Random(5)
    batches = [[(f"u{rnd.randint(1, 4)}", str(rnd.randint(1, 2))) for _ in range(6)] for _ in range(7)]
    plain = AdClickGuard(spark, os.path.join(tmp_root, "plain"), threshold=4, compact_every=0)
    folded = AdClickGuard(spark, os.path.join(tmp_root, "folded"), threshold=4, compact_every=2)
    for b, rows in enumerate(batches):
        df = _ads_df(spark, rows)
        plain.process(df, b)
        folded.process(df, b)
        if b == 4:
            folded.process(df, b)  # replay right after a fold
    key = lambda g: sorted(map(tuple, g.user_day_counts().collect()))
    assert key(folded) == key(plain)
    assert sorted(map(tuple, folded.blocked().collect())) == sorted(map(tuple, plain.blocked().collect()))
    assert folded.accepted().count() == plain.accepted().count()
    assert len(plain.counts.runs()) > 4
    assert len(folded.counts.runs()) <= 4 and all(r.hi < 7 for r in folded.counts.runs())  # at most one run per level, and the newest


def test_guard_folds_days_by_their_own_increments(spark, tmp_root):
    """A day touched only in odd batches folds as well."""
    guard = AdClickGuard(spark, tmp_root, threshold=100, compact_every=2)
    day = lambda ms: parse_ads_lines(spark.createDataFrame([(ms, f"{ms} A C u1 1")], "event_id long, value string"))[0]
    for b in range(6):
        guard.process(day(1598500000000 + (b % 2) * 86_400_000), b)
    for d in ("2020-08-27", "2020-08-28"):
        assert len(guard.counts.runs([d])) <= 2
    assert {(r.date, r.n) for r in guard.user_day_counts().collect()} == {("2020-08-27", 3), ("2020-08-28", 3)}


def test_guard_state_is_not_shuffled(spark, tmp_root):
    """Blocked users and counts are read by bucket: every exchange lies on the batch's side of a join."""
    guard = AdClickGuard(spark, tmp_root, threshold=2, buckets=4)
    for b in range(3):
        guard.process(_ads_df(spark, [("u1", "1"), ("u1", "1"), (f"u{b}", "2")]), b)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for plan, scans in ((guard.filtered(_ads_df(spark, [("u1", "1")]), 3), 1), (guard.newly_blocked(2, ["2020-08-27"]), 2)):
            lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
            at = [i for i, x in enumerate(lines) if "FileScan parquet" in x]
            assert len(at) == scans and all("Bucketed: true" in lines[i] for i in at)
            for i in at:  # from the scan up to the join: no exchange at this depth of the plan's left edge
                depth = len(lines[i]) - len(lines[i].lstrip(" :+-"))
                for x in reversed(lines[:i]):
                    here = len(x) - len(x.lstrip(" :+-"))
                    if here < depth:
                        depth = here
                        assert "Exchange" not in x, x
                        if "Join" in x:
                            break
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_state_files_stay_flat(spark, tmp_root):
    """60 batches of one day: runs, and files per read, grow with the logarithm; values stay right at every step."""
    from pyspark.sql import types as T

    from clickpulse.sinks.keyed import KeyedTable

    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType()), T.StructField("date", T.StringType())])
    table = KeyedTable(spark, os.path.join(tmp_root, "t"), ["date", "k"], schema, "date", "sum", ["k"], buckets=2, fan_in=4)
    most = 0
    for b in range(60):
        table.upsert(spark.createDataFrame([("a", 1, "d1"), (f"k{b % 5}", 1, "d1")], schema), b)
        table.fold(b, ["d1"])
        most = max(most, len(table.runs()))
    assert most <= 10  # three of each of three levels, and the newest
    assert {r.k: r.n for r in table.read().collect()} == {"a": 60, **{f"k{i}": 12 for i in range(5)}}
    files = [f for _, _, names in os.walk(os.path.join(tmp_root, "t")) for f in names if f.endswith(".parquet")]
    assert len(files) <= 2 * most  # folded runs are gone from the folder, too


def test_running_state_equals_the_sink_after_a_restart(spark, tmp_root):
    """The state store's counts, read from the checkpoint, equal the result table, also after a restart with other shuffle settings."""
    from clickpulse.streaming.counts import audit_totals, running_state

    tables = DayAreaAdTables(spark, os.path.join(tmp_root, "t"), 3)
    build = lambda s: day_area_city_counts_stream(parse_ads_lines(s)[0])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts, batch in (("3", [(0, "1"), (1, "1"), (9, "2")]), ("7", [(5, "1"), (90000, "3")])):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            run_replay(spark, "t", _feed(spark, [batch]), LINE_FEED_SCHEMA, build, tables.process, "update", root=tmp_root)
            state = running_state(spark, os.path.join(tmp_root, "checkpoint"))
            assert state.agg(F.sum("n")).first()[0] == tables.city_counts.read().agg(F.sum("n")).first()[0]
            assert audit_totals(state, tables.city_counts.read()).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    wrong = tables.city_counts.read().withColumn("n", F.when(F.col("adid") == "3", F.col("n") + 1).otherwise(F.col("n")))
    assert [(r.adid, r.in_state, r.in_table) for r in audit_totals(state, wrong.where("adid <> '2'")).orderBy("adid").collect()] == [("2", 1, None), ("3", 1, 2)]


def test_trend_replay_hours_later_gives_the_same_trend(spark, tmp_root):
    """A line dated two hours ahead does not move the clock at first, and not in a replay three hours later either."""
    trend = TrendTables(spark, tmp_root, 60)
    arrival = 1_598_500_000_000_000
    batch = _feed(spark, [[(0, "a1"), (7200, "a2")]]).select("event_id", "value")
    trend.add_rows(parse_ads_lines(batch)[0], 0, arrival)
    first = sorted(map(tuple, trend.trend.read().collect()))
    assert [x[0] for x in first] == ["a1"]
    trend.add_rows(parse_ads_lines(batch)[0], 0, arrival + 3 * 3_600_000_000)
    assert sorted(map(tuple, trend.trend.read().collect())) == first
    assert trend.minutes.read().agg(F.sum("n")).first()[0] == 2


def test_inline_fan_out_keeps_null_keys(spark, tmp_root):
    """Two batches of five rows without an area: one aggregate feeds both results, and the totals are 10."""
    from clickpulse.streaming.app import AdsApp

    app = AdsApp(spark, tmp_root, threshold=100, fanout="inline")
    for b in range(2):
        rows = _ads_df(spark, [("u1", "1")] * 5).withColumn("area", F.lit(None).cast("string"))
        app.guard.process(rows, b)
        app._fan_out(b)
        app._fan_out(b)  # a replay adds nothing
    assert [(r.area, r.n) for r in app.day_area.city_counts.read().collect()] == [(None, 10)]
    assert app.day_area.top.read().first().top_json == '[{"1":10}]'
    assert app.trend.minutes.read().agg(F.sum("n")).first()[0] == 10


def test_guard_rewrites_a_batch_that_was_cut_short(spark, tmp_root):
    """Rows of a batch without its marker are replaced when the batch is replayed."""
    guard = AdClickGuard(spark, tmp_root, threshold=100)
    batch = _ads_df(spark, [("u1", "1"), ("u2", "1"), ("u3", "1")])
    part = AdClickGuard(spark, os.path.join(tmp_root, "part"), threshold=100)
    part.process(batch.limit(1), 0)
    part.accepted().write.mode("append").partitionBy("batch_id").parquet(guard.accepted_path)
    assert not guard.accepted_written(0)
    guard.process(batch, 0)
    guard.process(batch, 0)
    assert guard.accepted_written(0) and guard.accepted().count() == 3
    guard.process(_ads_df(spark, [("u4", "1")]), 1)
    assert os.listdir(guard.commits_path) == ["1"]  # older markers are gone
    guard.expire_accepted(1)
    assert guard.accepted().count() == 1
    assert sum(r.n for r in guard.user_day_counts().collect()) == 4


def test_stream_tables_with_compaction_every_batch(spark, tmp_root):
    """Q6/Q7 and Q8 sinks give the same tables when folding on every batch."""
    batches = [[(0, "1"), (70, "2")], [(5, "1"), (130, "1")], [(200, "2"), (3700, "1")], [(3800, "2")]]
    results = []
    for every in (0, 1):
        root = os.path.join(tmp_root, f"c{every}")
        da = DayAreaAdTables(spark, os.path.join(root, "da"), 3, compact_every=every)
        tr = TrendTables(spark, os.path.join(root, "tr"), 60, compact_every=every)
        run_replay(spark, "da", _feed(spark, batches), LINE_FEED_SCHEMA,
                   lambda s: day_area_city_counts_stream(parse_ads_lines(s)[0]), da.process, "update",
                   root=os.path.join(root, "f1"))
        run_replay(spark, "tr", _feed(spark, batches), LINE_FEED_SCHEMA,
                   lambda s: parse_ads_lines(s)[0], tr.add_rows,
                   root=os.path.join(root, "f2"))
        results.append((
            sorted(map(tuple, da.city_counts.read().collect())),
            sorted(map(tuple, da.top.read().collect())),
            sorted(map(tuple, tr.minutes.read().collect())),
            sorted(map(tuple, tr.trend.read().collect())),
        ))
    assert results[0] == results[1]
    assert results[0][3] == [("1", '[{"04:48":1}]'), ("2", '[{"04:50":1}]')]


def test_text_line_stream_word_count(spark, tmp_root):
    """S7 / A15: a folder of text files as a stream, running word counts across two runs."""
    from clickpulse.streaming.counts import WordCountTable, word_count_stream
    from clickpulse.streaming.feed import start_foreach_batch, text_line_stream

    inbox = os.path.join(tmp_root, "texts")
    os.makedirs(inbox)
    table = WordCountTable(spark, os.path.join(tmp_root, "wc"))
    ckpt = os.path.join(tmp_root, "ckpt")
    for i, text in enumerate(["a b a", "b c"]):
        with open(os.path.join(inbox, f"f{i}.txt"), "w", encoding="utf-8") as fh:
            fh.write(text + "\n")
        q = start_foreach_batch(word_count_stream(text_line_stream(spark, inbox), column="value"), table.process,
                                ckpt, "update")
        q.awaitTermination()
    assert sorted(map(tuple, table.table.read().collect())) == [("a", 2), ("b", 2), ("c", 1)]


def test_day_area_with_retention_equals_exact_for_in_order_data(spark, tmp_root):
    """Bounded state (watermarked day windows) gives the same counts when rows arrive in order."""
    day = 86_400
    batches = [[(0, "1"), (10, "2")], [(day, "1"), (day + 5, "1")], [(2 * day, "2")], [(3 * day, "1")]]
    results = []
    for retain in (None, 1):
        root = os.path.join(tmp_root, f"r{retain}")
        da = DayAreaAdTables(spark, os.path.join(root, "da"), 3)
        run_replay(spark, "da", _feed(spark, batches), LINE_FEED_SCHEMA,
                   lambda s, r=retain: day_area_city_counts_stream(parse_ads_lines(s)[0], r), da.process, "update",
                   root=os.path.join(root, "f"))
        results.append(sorted(map(tuple, da.city_counts.read().collect())))
    assert results[0] == results[1]
    assert len({r[0] for r in results[0]}) == 4


def test_console_sink_runs(spark, tmp_root):
    from clickpulse.streaming.counts import word_count_stream
    from clickpulse.streaming.feed import start_console, text_line_stream

    inbox = os.path.join(tmp_root, "t")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "a.txt"), "w", encoding="utf-8") as fh:
        fh.write("x y x\n")
    q = start_console(word_count_stream(text_line_stream(spark, inbox), column="value"),
                      checkpoint=os.path.join(tmp_root, "ck"), available_now=True)
    q.awaitTermination()
    assert q.exception() is None
