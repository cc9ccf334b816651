"""Property tests: random inputs against brute-force Python."""

from __future__ import annotations

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clickpulse.operators import ads as AD
from clickpulse.operators import jumps as J
from clickpulse.schemas import USER_VISIT_ACTION
from tests.conftest import visit_row

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

visit_lists = st.lists(
    st.tuples(st.sampled_from(["a", "b", "hot", "hot", "hot"]), st.integers(1, 4), st.integers(0, 5)),
    min_size=1, max_size=60,
)


@SETTINGS
@given(rows=visit_lists, slices=st.integers(1, 12))
def test_next_page_matches_brute_force(spark, rows, slices):
    data = [visit_row(i, 1, s, page, sec) for i, (s, page, sec) in enumerate(rows)]
    visits = spark.createDataFrame(data, USER_VISIT_ACTION)
    got = {r.event_id: r.next_page for r in J.session_next_page(visits, slices).collect()}
    want = {}
    for s in {r[2] for r in data}:
        seq = sorted((r for r in data if r[2] == s), key=lambda r: (r[4], r[13]))
        for a, b in zip(seq, seq[1:] + [None]):
            want[a[13]] = None if b is None else b[3]
    assert got == want


@SETTINGS
@given(rows=visit_lists)
def test_jump_ratio_in_unit_interval(spark, rows):
    data = [visit_row(i, 1, s, page, sec) for i, (s, page, sec) in enumerate(rows)]
    for r in J.page_jump_ratio(spark.createDataFrame(data, USER_VISIT_ACTION), "1,2,3,4", "t").collect():
        assert 0.0 < r.ratio <= 1.0


clicks = st.lists(
    st.tuples(st.integers(0, 3), st.sampled_from(["u1", "u2", "u3"]), st.sampled_from(["1", "2"]),
              st.sampled_from(["d1", "d2"])),
    min_size=1, max_size=40,
)


def _simulate(rows, threshold):
    """The guard, one batch at a time, in plain Python."""
    blocked, counts, accepted = set(), {}, []
    for b in sorted({r[0] for r in rows}):
        batch = [r for r in rows if r[0] == b and r[1] not in blocked]
        accepted += batch
        newly = set()
        for _, u, ad, d in batch:
            counts[(d, u, ad)] = counts.get((d, u, ad), 0) + 1
            if counts[(d, u, ad)] >= threshold:
                newly.add(u)
        blocked |= newly
    return sorted(accepted)


@SETTINGS
@given(rows=clicks, threshold=st.integers(1, 4))
def test_guard_formula_matches_simulation(spark, rows, threshold):
    df = spark.createDataFrame(rows, "batch_id long, userid string, adid string, date string")
    got = sorted(tuple(r) for r in AD.ads_guard_accepted(df, threshold).select("batch_id", "userid", "adid", "date").collect())
    assert got == _simulate(rows, threshold)


@SETTINGS
@given(counts=st.lists(st.integers(1, 500), min_size=1, max_size=6))
def test_city_share_adds_up(spark, counts):
    from clickpulse.operators.area import city_click_share

    rows = [("X", 1, f"c{i}", n) for i, n in enumerate(counts)]
    text = city_click_share(spark.createDataFrame(rows, "area string, product_id long, city_name string, n long")).first()[2]
    parts = [float(x.split(":")[1].rstrip("%")) for x in text.split(",")]
    assert abs(sum(parts) - 100.0) <= 0.1 + 1e-9
    assert len(parts) == min(len(counts), 2) + 1


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=clicks, threshold=st.integers(1, 3))
def test_stream_guard_matches_simulation(spark, rows, threshold):
    """The foreachBatch guard, fed batch by batch, accepts exactly what the simulation accepts."""
    import tempfile

    from clickpulse.streaming.guard import AdClickGuard

    guard = AdClickGuard(spark, tempfile.mkdtemp(prefix="guard-prop-"), threshold, compact_every=2)
    day = {"d1": "2020-08-27", "d2": "2020-08-28"}
    for b in sorted({r[0] for r in rows}):
        batch = [(u, ad, day[d]) for bb, u, ad, d in rows if bb == b]
        df = spark.createDataFrame(batch, "userid string, adid string, date string").selectExpr(
            "CAST(NULL AS BIGINT) AS event_id", "0L AS timestamp", "'A' AS area", "'C' AS city", "userid", "adid",
            "CAST(NULL AS TIMESTAMP_NTZ) AS ts", "date")
        guard.process(df, b)
    got = sorted((r.batch_id, r.userid, r.adid, {v: k for k, v in day.items()}[r.date])
                 for r in guard.accepted().collect())
    assert got == _simulate(rows, threshold)


def test_session_starts_without_any_configuration(tmp_path):
    """A plain session with an empty conf folder: starts and writes scratch data."""
    import subprocess
    import sys
    from pathlib import Path

    code = (
        "from clickpulse import get_spark, scratch_dir\n"
        "s = get_spark(master='local[1]')\n"
        "d = scratch_dir(s, 'x')\n"
        "s.range(3).write.parquet(d)\n"
        "assert s.read.parquet(d).count() == 3\n"
    )
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(Path(__file__).resolve().parent.parent)}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=200)
    assert out.returncode == 0, out.stderr[-2000:]
