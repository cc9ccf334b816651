from __future__ import annotations

import __spark_entry__ as E

from clickpulse.plans import oracle, registry


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["task_id", "category", "click", "order", "pay"]
    assert 0 < len(rows) <= 10


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(registry.queries()) <= set(E.queries())


def test_batch_queries_run_on_smoke_data(spark):
    from clickpulse.plans.streams import stream_queries

    streams = set(stream_queries())
    for name, fn in registry.queries().items():
        if name in streams:
            continue
        assert fn(spark, E.SMOKE_DIR).count() >= 0, name
