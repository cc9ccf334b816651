"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``: one warm-up, then the median of ``$BENCH_RUNS`` (default 3)
timed runs, each fully executed into the ``noop`` sink (no collect). Streaming
queries warm up on ``$BENCH_WARM_DIR`` (default sf0.001) and are then timed once
(each run replays all micro-batches). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickpulse.plans import registry  # noqa: E402
from clickpulse.plans.streams import stream_queries  # noqa: E402
from clickpulse.session import get_spark  # noqa: E402

BATCH_KEYS = [
    "category_top10",
    "category_session_top10",
    "page_jump_ratio",
    "area_product_top3",
    "ads_guard_batches",
    "ads_day_area_top3",
    "ads_sliding_counts",
    "ads_last_hour_trend",
    "word_count",
]
STREAM_KEYS = ["ads_guard_stream", "stream_day_area_top3"]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    conf = {"spark.driver.memory": "8g"}
    event_dir = None
    if os.environ.get("BENCH_EVENT_LOG"):
        # Event log to a fresh scratch folder; summarise with tools/stage_report.py.
        import tempfile

        event_dir = tempfile.mkdtemp(prefix="clickpulse-events-")
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = get_spark(
        app="clickpulse-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        conf=conf,
    )
    qs = registry.queries()
    sq = stream_queries()
    out: dict[str, float] = {}
    sc = spark.sparkContext
    for key in BATCH_KEYS:
        fn = qs[key]
        sc.setJobDescription(f"{key} warm-up")
        _run(fn(spark, sf_dir))  # warm-up
        times = []
        for i in range(runs):
            sc.setJobDescription(f"{key} run {i}")
            t0 = time.perf_counter()
            _run(fn(spark, sf_dir))
            times.append(time.perf_counter() - t0)
        out[key] = round(statistics.median(times), 3)
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for key in STREAM_KEYS:
        if os.path.isdir(warm_dir):
            sc.setJobDescription(f"{key} warm-up")
            _run(sq[key](spark, warm_dir))  # warm-up on the smallest tables (streams replay 5-6 batches)
        sc.setJobDescription(f"{key} run 0")
        t0 = time.perf_counter()
        _run(sq[key](spark, sf_dir))
        out[key] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(out.values()), 3),
                "unit": "sec",
                "queries": out,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
                "spark": spark.version,
                "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
                **({"event_log": event_dir} if event_dir else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
