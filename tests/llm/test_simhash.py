"""SimHash near-duplicates against brute force and messy small tables."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clickpulse.llm import queries, simhash

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_fingerprint(text: str | None) -> int:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids: list, fps: list[int], distance: int = 2) -> list:
    """The smallest id reachable of every row; links are between rows, not ids."""
    up = list(range(len(fps)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                up[root(i)] = root(j)
    least: dict = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [least.get(root(i)) for i in range(len(ids))]


def key(rows):
    return sorted(rows, key=repr)


def compare(df, rows):
    got = key([(r.doc_id, r.fingerprint, r.component_id) for r in df.collect()])
    fps = [brute_fingerprint(r[1]) for r in rows]
    want = key([(r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, brute_components([r[0] for r in rows], fps))])
    assert got == want


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    compare(queries.op11_simhash(spark, SF), rows)


def test_messy_rows(spark):
    long_text = "alpha beta gamma delta epsilon " * 30_000
    rows = [(1, "The quick brown FOX jumps over"), (1, "the quick brown fox jumps over"), (2, "the quick brown fox jumps over"), (1, "other words under one id here"),
            (9, None), (4, ""), (5, " \t\n"), (None, "der schnelle braune fuchs springt"), (None, None), (6, long_text), (7, "Ä ä"), (8, "zwei"), (None, "allein ohne nummer hier")]
    df = spark.createDataFrame([(a, b, None, None, None) for a, b in rows], DOCS)
    df = df.withColumns({c: F.lit(7) for c in ("fp", "u", "v", "key", "FIRST", "root", "component_id", "node")})
    compare(simhash.simhash_report(df), rows)


def test_empty_table(spark):
    out = simhash.simhash_report(spark.createDataFrame([], DOCS))
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0


@pytest.mark.parametrize("bucket", [2, 10_000])
def test_all_pairs_within_two_bits(spark, bucket):
    """Dense neighbourhoods and random values; with a small bucket nearly all lookups take the whole ball."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 12, np.int64)
    values = {int(x) for x in base} | {0, -1, 1, -(1 << 63)}
    for x in base.tolist():
        for _ in range(25):
            y = x
            for b in rng.integers(0, 64, rng.integers(1, 4)).tolist():
                y ^= 1 << b
            values.add(int(np.uint64(y & (2**64 - 1)).astype(np.int64)))
    values = sorted(values)
    got = {tuple(sorted(r)) for r in simhash.close_pairs(spark.createDataFrame([(v,) for v in values], "fp long"), bucket=bucket).collect()}
    mask = (1 << 64) - 1
    want = {(a, b) for i, a in enumerate(values) for b in values[i + 1:] if ((a ^ b) & mask).bit_count() <= 2}
    assert got == want and len(want) > 50


def test_shared_halves_stay_linear(spark):
    """Many fingerprints with one half in common and no link: lookups of that bucket make no pairs among them."""
    values = [(i * 0x9E3779B97F4A7C15 & 0xFFFFFFFF) << 32 | 5 for i in range(1, 700)]
    df = spark.createDataFrame([(v if v < 1 << 63 else v - (1 << 64),) for v in values], "fp long")
    want = sum((a ^ b).bit_count() <= 2 for i, a in enumerate(values) for b in values[:i])
    assert simhash.close_pairs(df, bucket=64).select(F.least("u", "v"), F.greatest("u", "v")).distinct().count() == want
