"""Pipelined lexical search against its SQL twin, brute force and messy small tables."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from clickpulse.llm import lexical, queries, sql

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = "item_id long, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, top=20):
    parsed = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    n_docs, length = sum(n > 0 for *_, n in parsed), sum(n for *_, n in parsed)
    df = Counter(t for _, c, _ in parsed for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for t, k in df.items()}
    out = []
    for item, text in items:
        asked = Counter(terms(text))
        found = []
        for d, c, n in parsed:
            score = sum(times * w[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * (75 + 25 * n * n_docs // length))) for t, times in asked.items() if t in c)
            if score > 0:
                found.append((-score, d is None, d if d is not None else 0))
        out += [(item, k + 1, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(found)[:top])]
    return sorted(out, key=repr)


def compare(df, docs, items, top=20):
    assert sorted(map(tuple, df.collect()), key=repr) == brute(docs, items, top)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.op12_lexical_search(spark, SF)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, df.collect())) == sorted(con.sql(sql.OP12).fetchall())


@pytest.mark.parametrize("owners, shard_docs, lane_items", [(1, 1 << 14, 1024), (3, 7, 2), (5, 40, 1024)])
def test_random_corpora(spark, monkeypatch, owners, shard_docs, lane_items):
    """Few distinct terms with many ties and copies; small shards and several lanes make every document cross the pipeline."""
    monkeypatch.setattr(lexical, "LANE_ITEMS", lane_items)
    rng = random.Random(owners)
    vocab = [f"t{i}" for i in range(40)] + ["É", "é", "ABC", "abc", "x-y"]
    pick = lambda k: " ".join(rng.choices(vocab, [1 / (i + 1) for i in range(len(vocab))], k=k))
    docs = [(rng.randint(0, 150), pick(rng.randint(0, 60))) for _ in range(250)] + [(1000 + i, "t1 t2 t3 t44") for i in range(60)]
    items = [(i, pick(rng.randint(1, 12))) for i in range(9)]
    got = lexical.ranked_search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS), 20, owners, shard_docs)
    compare(got, docs, items)


def test_messy_rows(spark, monkeypatch):
    monkeypatch.setattr(lexical, "FILTER_BYTES", 0)  # no first filter: the join with the terms does it alone
    docs = [(1, "Alpha beta"), (1, "alpha BETA"), (2, "gamma\x00delta"), (None, "alpha"), (None, None), (3, ""), (4, "?! -"), (5, "alpha " * 50_000 + "omega"), (6, "Ärger ärger 語")]
    items = [(1, "alpha alpha omega"), (1, "delta"), (None, "beta"), (2, None), (3, ""), (4, "nowhere"), (5, "ärger"), (6, "語 Ä")]
    odd = {c: F.lit(7) for c in ("row", "n", "term", "terms", "tid", "item", "lane", "ID", "score", "rank", "shard")}
    d = spark.createDataFrame([(a, b, None, None, None) for a, b in docs], DOCS).withColumns(odd)
    compare(lexical.search_items(d, spark.createDataFrame(items, ITEMS).withColumns(odd)), docs, items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], ITEMS)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        out = lexical.search_items(d, i)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0
