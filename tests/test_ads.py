from __future__ import annotations

import random

from pyspark.sql import functions as F

from clickpulse.operators import ads as AD

LINES = [
    "1598500000000 华北 北京 1 3",
    "1598500005000 华北 天津 2 3",
    "1598500010000 华北 北京 1 1",
    "1598500025000 华东 上海 3 2",
    "bad line",
]


def _parsed(spark, lines=LINES):
    return AD.parse_ads_lines(spark.createDataFrame([(x,) for x in lines], "value string"))


def test_parse_and_rejects(spark):
    ok, bad = _parsed(spark)
    assert ok.count() == 4
    assert [tuple(r) for r in bad.collect()] == [("bad line", "too few fields")]
    r = ok.where(F.col("timestamp") == 1598500000000).first()
    assert (r.area, r.city, r.userid, r.adid, r.date) == ("华北", "北京", "1", "3", "2020-08-27")
    assert str(r.ts) == "2020-08-27 03:46:40"


def test_parse_bad_timestamp_and_zone(spark):
    ok, bad = _parsed(spark, ["x a b c d", "1598500000000 a b c d"])
    assert [tuple(r) for r in bad.collect()] == [("x a b c d", "bad timestamp")]
    ok, bad = _parsed(spark, ["1598500000000 a b c ", "1598500000000 a  c d", "1598500000000 a b c d "])
    assert sorted(tuple(r)[1:5] for r in ok.select("timestamp", "area", "city", "userid", "adid").collect()) == [("a", "", "c", "d"), ("a", "b", "c", "d")]
    assert [tuple(r) for r in bad.collect()] == [("1598500000000 a b c ", "too few fields")]
    shanghai, _ = AD.parse_ads_lines(spark.createDataFrame([("1598500000000 a b c d",)], "value string"), tz="Asia/Shanghai")
    assert str(shanghai.first().ts) == "2020-08-27 11:46:40"


def test_day_area_city_counts_and_top3(spark):
    ads, _ = _parsed(spark)
    got = sorted((r.area, r.city, r.adid, r.n) for r in AD.day_area_city_ad_counts(ads).collect())
    assert got == [("华东", "上海", "2", 1), ("华北", "北京", "1", 1), ("华北", "北京", "3", 1), ("华北", "天津", "3", 1)]
    top = {r.area: r.top_json for r in AD.day_area_ad_top_n(AD.day_area_ad_counts(AD.day_area_city_ad_counts(ads))).collect()}
    assert top == {"华北": '[{"3":2},{"1":1}]', "华东": '[{"2":1}]'}


def test_minute_trend(spark):
    ads, _ = _parsed(spark)
    got = {r.adid: r.trend_json for r in AD.ad_last_hour_trend(AD.ad_minute_counts(ads), 60).collect()}
    assert got == {"3": '[{"03:46":2}]', "1": '[{"03:46":1}]', "2": '[{"03:47":1}]'}


def test_trend_cuts_to_last_length_minutes(spark):
    base = 1598500000000
    lines = [f"{base + m * 60000} a b 1 7" for m in (0, 1, 5, 9, 10)]
    ads, _ = _parsed(spark, lines)
    got = AD.ad_last_hour_trend(AD.ad_minute_counts(ads), 5).first().trend_json
    # now = 03:56; keep (03:51, 03:56]
    assert got == '[{"03:55":1},{"03:56":1}]'
    assert AD.ad_recent_trend(ads, 5).first().trend_json == got
    assert AD.ad_recent_trend(ads.limit(0), 5).count() == 0


def test_top_n_ties_by_adid_and_limit(spark):
    rows = [("d", "A", str(ad), n) for ad, n in ((5, 3), (2, 3), (9, 3), (1, 1))]
    df = spark.createDataFrame(rows, "date string, area string, adid string, n long")
    assert AD.day_area_ad_top_n(df, 3).first().top_json == '[{"2":3},{"5":3},{"9":3}]'


def test_sliding_counts_equal_spark_window(spark):
    rnd = random.Random(11)
    base = 1598500000000
    lines = [f"{base + rnd.randint(0, 3_600_000)} a b u{rnd.randint(1, 3)} {rnd.randint(1, 4)}" for _ in range(500)]
    ads, _ = _parsed(spark, lines)
    mine = AD.ad_sliding_counts(ads, 3, 1)
    theirs = (
        ads.groupBy("adid", F.window(F.col("ts"), "3 minutes", "1 minute").alias("w"))
        .agg(F.count("*").alias("n"))
        .select("adid", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")
    )
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, theirs.collect()))


def test_blacklist_and_filter(spark):
    lines = [f"1598500000000 a b u1 1"] * 3 + ["1598500000000 a b u2 1"] * 2 + ["1598500000000 a b  1"]
    ads, _ = _parsed(spark, lines)
    blocked = AD.ads_blacklist(ads, 3)
    assert [r.userid for r in blocked.collect()] == ["u1"]
    kept = AD.ads_blacklist_filter(ads, blocked)
    assert sorted(r.userid for r in kept.collect()) == ["", "u2", "u2"]


def test_guard_formula_fixture(spark):
    """FIXTURES.md 4.4: threshold 3, three batches in one day."""
    batches = [[("u1", "1"), ("u1", "1"), ("u2", "1")], [("u1", "1"), ("u1", "1"), ("u1", "2")], [("u1", "2"), ("u2", "1")]]
    rows = [("2020-08-27", u, ad, b) for b, items in enumerate(batches) for u, ad in items]
    df = spark.createDataFrame(rows, "date string, userid string, adid string, batch_id long")
    acc = AD.ads_guard_accepted(df, 3)
    per_batch = {b: n for b, n in acc.groupBy("batch_id").count().collect()}
    assert per_batch == {0: 3, 1: 3, 2: 1}
    assert [tuple(r) for r in AD.ads_guard_blocked(df, 3).collect()] == [("u1", 1)]


def test_word_count(spark):
    df = spark.createDataFrame([("a b  a",), ("b",), (None,)], "text string")
    assert sorted(map(tuple, AD.word_count(df).collect())) == [("a", 2), ("b", 2)]
