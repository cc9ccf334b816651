"""Every batch query equals its DuckDB SQL on the smallest tables (the driver's check, in pytest)."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as E
from clickpulse.plans.streams import stream_queries
from clickpulse.sources.tables import DRIVER_TABLES
from tools.check_oracle import _digest

SF = "/root/testdata/sf0.001"
BATCH_KEYS = sorted(set(E.oracle_sql()) - set(stream_queries()))


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_batch_query_matches_sql(spark, duck, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)
