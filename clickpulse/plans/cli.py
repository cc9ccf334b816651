"""Command-line entry points (``spark-submit clickpulse/plans/cli.py <job> ...``).

Jobs:
  category   Q1 + Q2 on the filtered visits
  jump       Q3 page-jump ratios
  area       Q4 area top-N with city share
  ads-app    Q5-Q8 streaming app (Kafka topic or a folder of text files)

Inputs are catalog table names or parquet paths (anything with a ``/`` is a path).
Parameters come from flags or from the job-parameter properties file
(``--conditions conditions.properties``). Results go to parquet (``--out``) or
JDBC (``--jdbc-url`` with ``--jdbc-user`` / ``--jdbc-password``).
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from clickpulse import constants as C  # noqa: E402
from clickpulse.plans.jobs import Conditions, area_job, category_jobs, jdbc_sink, jump_job, parquet_sink  # noqa: E402
from clickpulse.schemas import CITY_INFO, PRODUCT_INFO, USER_INFO, USER_VISIT_ACTION, rescue  # noqa: E402
from clickpulse.session import CLUSTER_CONF, get_spark  # noqa: E402


def _table(spark, name_or_path: str, schema, rejects: str | None, optional: tuple[str, ...] = ()):
    """A table with its declared types; rows that cannot be converted are written to ``rejects``, or fail the job."""
    raw = spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(name_or_path)
    rows, bad = rescue(raw, schema, name_or_path, optional)
    if rejects:
        bad.write.mode("append").parquet(os.path.join(rejects, os.path.basename(name_or_path.rstrip("/"))))
    elif not bad.isEmpty():
        raise ValueError(f"{name_or_path}: {bad.first().reason}; --rejects keeps such rows aside")
    return rows


def _sink(args):
    if args.jdbc_url:
        props = {k: v for k, v in (("user", args.jdbc_user), ("password", args.jdbc_password)) if v}
        return jdbc_sink(args.jdbc_url, props)
    return parquet_sink(args.out)


def _conditions(spark, args) -> Conditions:
    if args.conditions:
        from clickpulse.sources.params import read_properties_value

        cond = Conditions.from_row(read_properties_value(spark, args.conditions).first())
    else:
        cond = Conditions()
    for field in ("start_date", "end_date", "start_age", "end_age", "target_page_flow"):
        v = getattr(args, field, None)
        if v not in (None, ""):
            setattr(cond, field, v)
    return cond


def build_parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="clickpulse", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("job", choices=["category", "jump", "area", "ads-app"])
    ap.add_argument("--visits", default="user_visit_action")
    ap.add_argument("--users", default="user_info")
    ap.add_argument("--cities", default="city_info")
    ap.add_argument("--products", default="product_info")
    ap.add_argument("--conditions", help="properties file with condition.params.json")
    ap.add_argument("--start-date", dest="start_date")
    ap.add_argument("--end-date", dest="end_date")
    ap.add_argument("--start-age", dest="start_age")
    ap.add_argument("--end-age", dest="end_age")
    ap.add_argument("--target-page-flow", dest="target_page_flow")
    ap.add_argument("--rejects", help="folder for rows whose values do not fit the declared types (default: they fail the job)")
    ap.add_argument("--out", default="clickpulse-out", help="parquet output folder (shared storage)")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-user")
    ap.add_argument("--jdbc-password")
    # streaming
    ap.add_argument("--kafka-servers")
    ap.add_argument("--topic", default="ads_log")
    ap.add_argument("--max-offsets", type=int, help="Kafka: offsets a micro-batch takes at most")
    ap.add_argument("--min-partitions", type=int, help="Kafka: tasks a micro-batch is read with at least")
    ap.add_argument("--allow-data-loss", action="store_true", help="Kafka: go on when offsets are gone")
    ap.add_argument("--lines-dir", help="folder of text files with ad lines (instead of Kafka)")
    ap.add_argument("--state-root", help="shared folder for the app's tables and checkpoints")
    ap.add_argument("--fanout", choices=["inline", "stream"], default="inline")
    ap.add_argument("--top-n", type=int, default=C.TOP_ADS)
    ap.add_argument("--trend-minutes", type=int, default=C.TREND_MINUTES)
    ap.add_argument("--retain-days", type=int, help="stream fan-out: drop running counts of older days")
    ap.add_argument("--cluster", action="store_true", help="apply session.CLUSTER_CONF")
    ap.add_argument("--threshold", type=int, default=C.BLOCK_THRESHOLD)
    ap.add_argument("--state-partitions", type=int, help="state partitions of the streaming aggregations")
    ap.add_argument("--trigger", default="3 seconds")
    ap.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    return ap


def main(argv: list[str] | None = None) -> None:
    parser = build_parser()
    args = parser.parse_args(argv)
    if args.job == "ads-app" and not args.state_root:
        parser.error("ads-app needs --state-root")
    spark = get_spark(app=f"clickpulse-{args.job}", conf=CLUSTER_CONF if args.cluster else None)
    if args.job == "ads-app":
        from clickpulse.streaming.app import AdsApp
        from clickpulse.streaming.feed import kafka_line_stream, text_line_stream

        app = AdsApp(spark, args.state_root, args.threshold, args.top_n, args.trend_minutes, retain_days=args.retain_days,
                     state_partitions=args.state_partitions, fanout=args.fanout)
        lines = (text_line_stream(spark, args.lines_dir) if args.lines_dir
                 else kafka_line_stream(spark, args.kafka_servers, args.topic, max_offsets_per_trigger=args.max_offsets,
                                        min_partitions=args.min_partitions, fail_on_data_loss=not args.allow_data_loss))
        trigger = None if args.available_now else args.trigger
        queries = [app.start_guard(lines, args.available_now, trigger)]
        if args.available_now:
            queries[0].awaitTermination()
        queries += app.start_downstream(args.available_now, trigger)
        for q in queries:
            q.awaitTermination()
        return
    cond = _conditions(spark, args)
    visits = _table(spark, args.visits, USER_VISIT_ACTION, args.rejects, ("event_id",))
    sink = _sink(args)
    if args.job == "category":
        category_jobs(visits, _table(spark, args.users, USER_INFO, args.rejects), cond, sink)
    elif args.job == "jump":
        jump_job(visits, cond, sink)
    else:
        area_job(visits, _table(spark, args.cities, CITY_INFO, args.rejects), _table(spark, args.products, PRODUCT_INFO, args.rejects), sink)


if __name__ == "__main__":
    main()
