from __future__ import annotations

import os

from clickpulse.plans.jobs import Conditions, area_job, category_jobs, jump_job, parquet_sink
from clickpulse.plans.streams import LINE_FEED_SCHEMA
from clickpulse.sources.params import parse_conditions
from clickpulse.streaming.app import AdsApp
from clickpulse.streaming.feed import ReplayFeed


def test_batch_jobs_write_to_sink(spark, tmp_root, fixture_visits, fixture_users, fixture_cities, fixture_products):
    row = parse_conditions(spark.createDataFrame(
        [('{startAge: "20", endAge: "50", targetPageFlow: "1,2,3"}',)], "value string")).first()
    cond = Conditions.from_row(row)
    sink = parquet_sink(tmp_root)
    top, sessions = category_jobs(fixture_visits, fixture_users, cond, sink, "t")
    jump_job(fixture_visits, cond, sink, "t")
    area_job(fixture_visits, fixture_cities, fixture_products, sink, "t")
    assert [r.category for r in top.collect()] == ["2", "1"]
    for name, rows in (("category_top10", 2), ("category_session_top10", 3), ("jump_page_ratio", 2),
                       ("area_count_info", 2)):
        assert spark.read.parquet(os.path.join(tmp_root, name)).count() == rows, name


import pytest  # noqa: E402


@pytest.mark.parametrize("fanout", ["stream", "inline"])
def test_ads_app_end_to_end(spark, tmp_root, fanout):
    """Guard (threshold 2) then fan-out; the blocked user's later clicks never reach Q6-Q8."""
    lines = [
        (0, "1598500000000 A C1 u1 1", 0),
        (1, "1598500001000 A C1 u1 1", 0),
        (2, "1598500002000 A C2 u2 1", 0),
        (3, "1598500003000 A C1 u1 2", 1),  # u1 blocked after batch 0
        (4, "1598500004000 A C2 u2 2", 1),
        (5, "garbage", 1),
    ]
    feed_df = spark.createDataFrame(lines, "event_id long, value string, batch long")
    app = AdsApp(spark, os.path.join(tmp_root, "app"), threshold=2, top_n=3, trend_minutes=60, fanout=fanout)
    feed = ReplayFeed(spark, tmp_root)
    feed.run(feed_df, "batch", lambda: app.start_guard(feed.stream(LINE_FEED_SCHEMA)))
    for q in app.start_downstream():
        q.awaitTermination()
    counts = sorted((r.city, r.adid, r.n) for r in app.day_area.city_counts.read().collect())
    assert counts == [("C1", "1", 2), ("C2", "1", 1), ("C2", "2", 1)]
    assert app.day_area.top.read().first().top_json == '[{"1":3},{"2":1}]'
    assert {r.adid: r.trend_json for r in app.trend.trend.read().collect()} == {
        "1": '[{"03:46":3}]', "2": '[{"03:46":1}]'}
    assert [r.userid for r in app.guard.blocked().collect()] == ["u1"]
    assert [tuple(r) for r in app.rejects().collect()] == [("garbage", "too few fields", 1)]


def test_cli_batch_jobs(spark, tmp_root, fixture_visits, fixture_users, fixture_cities, fixture_products):
    from clickpulse.plans.cli import main

    paths = {}
    for name, df in (("visits", fixture_visits), ("users", fixture_users), ("cities", fixture_cities),
                     ("products", fixture_products)):
        paths[name] = os.path.join(tmp_root, name)
        df.write.parquet(paths[name])
    props = os.path.join(tmp_root, "conditions.properties")
    with open(props, "w", encoding="utf-8") as fh:
        fh.write('condition.params.json={startAge: "20", \\\n  endAge: "50", \\\n  targetPageFlow:"1,2,3"}\n')
    out = os.path.join(tmp_root, "out")
    common = ["--visits", paths["visits"], "--users", paths["users"], "--cities", paths["cities"],
              "--products", paths["products"], "--conditions", props, "--out", out]
    for job in ("category", "jump", "area"):
        main([job, *common])
    assert [r.category for r in spark.read.parquet(os.path.join(out, "category_top10")).orderBy("click", "order", "pay",
            ascending=False).collect()] == ["2", "1"]
    assert spark.read.parquet(os.path.join(out, "jump_page_ratio")).count() == 2
    assert spark.read.parquet(os.path.join(out, "area_count_info")).count() == 2


def test_cli_ads_app_on_text_files(spark, tmp_root):
    from clickpulse.plans.cli import main
    from clickpulse.streaming.counts import DayAreaAdTables

    lines_dir = os.path.join(tmp_root, "lines")
    os.makedirs(lines_dir)
    with open(os.path.join(lines_dir, "part-0.txt"), "w", encoding="utf-8") as fh:
        fh.write("1598500000000 A C1 u1 1\n1598500001000 A C1 u1 1\n1598500002000 A C2 u2 2\nbad\n")
    root = os.path.join(tmp_root, "app")
    main(["ads-app", "--lines-dir", lines_dir, "--state-root", root, "--threshold", "2", "--available-now"])
    counts = DayAreaAdTables(spark, os.path.join(root, "day_area"), 3).city_counts.read()
    assert sorted((r.city, r.adid, r.n) for r in counts.collect()) == [("C1", "1", 2), ("C2", "2", 1)]


def test_ads_app_inline_replay_is_idempotent(spark, tmp_root):
    """Inline fan-out: processing batch 1 twice gives the same tables as processing it once."""
    from clickpulse.streaming.app import AdsApp

    batches = [
        ["1598500000000 A C1 u1 1", "1598500001000 A C1 u2 1"],
        ["1598500060000 A C2 u1 2", "1598500061000 A C1 u3 1"],
        ["1598500120000 A C1 u2 1"],
    ]
    results = []
    for replay in (False, True):
        app = AdsApp(spark, os.path.join(tmp_root, f"r{replay}"), threshold=5, fanout="inline")
        for b, lines in enumerate(batches):
            df = spark.createDataFrame([(x,) for x in lines], "value string")
            app.process_lines(df, b)
            if replay and b == 1:
                app.process_lines(df, b)
        results.append((sorted(map(tuple, app.day_area.city_counts.read().collect())),
                        sorted(map(tuple, app.day_area.top.read().collect())),
                        sorted(map(tuple, app.trend.trend.read().collect()))))
    assert results[0] == results[1]
    assert results[0][1] == [("2020-08-27", "A", '[{"1":4},{"2":1}]')]


def test_command_line_of_the_app():
    from clickpulse.plans import cli

    with pytest.raises(SystemExit):
        cli.main(["ads-app"])  # no state root
    args = cli.build_parser().parse_args(["ads-app", "--state-root", "s", "--top-n", "5", "--trend-minutes", "30", "--fanout", "stream", "--retain-days", "9"])
    assert (args.top_n, args.trend_minutes, args.fanout, args.retain_days, args.cluster) == (5, 30, "stream", 9, False)
