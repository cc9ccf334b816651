"""URL filters by a Bloom filter cascade: exact membership of listed keys without joins.

A url's keys are its host suffixes followed by prefixes of its path. The universe is every key of
the corpus that has the shape of a listed one. Level 1 encodes the listed keys, level 2 the other
keys that level 1 lets through by mistake, level 3 the listed keys that level 2 holds by mistake, and
so on until no mistake is left; the last level a key passes then tells exactly whether it is listed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import small_arrow_batches, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed rules of the registered query: verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Fixed words: a host with one of them as a word of a label is listed.
LISTED_WORDS = ("adult", "ads", "bets", "casino", "pills", "spam")
MAX_MEGABYTES = 256  # most that the levels may hold together; they are sent to every executor
MAX_LEVELS = 64

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.translate(F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_hosts(pages: DataFrame, words: Sequence[str] = LISTED_WORDS) -> DataFrame:
    """The distinct hosts of ``pages`` that have a listed word, column ``key``."""
    pattern = f"(^|[.-])({'|'.join(words)})([.-]|$)"
    return pages.select(host_of(F.col("url")).alias("key")).where(F.col("key").rlike(pattern)).distinct()


def keys_of(host: Column, path: Column, shapes: Sequence[tuple[int, int]]) -> Column:
    """The url's keys of the given shapes (labels of the host suffix, characters of the path prefix), longest first."""
    labels = F.size(F.split(host, r"\."))
    parts = [F.when((host != "") & (labels >= n) & (F.length(path) >= p),
                    F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, p))) for n, p in shapes]
    keys = F.array_distinct(F.array_compact(F.array(*parts)))
    return F.array_sort(keys, lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0))


@dataclass
class Level:
    bits: np.ndarray  # bytes
    size: int
    hashes: int
    seed: int


def _positions(h1: np.ndarray, h2: np.ndarray, size: int, hashes: int, seed: int) -> np.ndarray:
    out = np.empty((hashes, len(h1)), np.int64)
    for i in range(hashes):
        x = h1.view(np.uint64) + np.uint64(seed * 64 + i + 1) * (_MIX[0] * (h2.view(np.uint64) | np.uint64(1)))
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
        out[i] = ((x ^ (x >> np.uint64(31))) % np.uint64(size)).view(np.int64)
    return out


def passes(h1: np.ndarray, h2: np.ndarray, level: Level) -> np.ndarray:
    at = _positions(h1, h2, level.size, level.hashes, level.seed)
    return ((level.bits[at >> 3] >> (at & 7)) & 1).all(axis=0)


def member(h1: np.ndarray, h2: np.ndarray, levels: list[Level]) -> np.ndarray:
    """Whether keys of the universe are listed: the number of levels passed in a row is odd."""
    found, alive = np.zeros(len(h1), bool), np.ones(len(h1), bool)
    for i, level in enumerate(levels):
        alive &= passes(h1, h2, level)
        found[alive] = i % 2 == 0
    return found


def _bits(size: int, hashes: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_positions(batch.column("h1").to_numpy(), batch.column("h2").to_numpy(), size, hashes, seed))
            words, starts = np.unique(at >> 6, return_index=True)
            each = np.uint64(1) << (at & 63).astype(np.uint64)
            packed = np.bitwise_or.reduceat(each, starts) if len(at) else each
            yield pa.record_batch([pa.array(words, pa.int64()), pa.array(packed.view(np.int64), pa.int64())], names=["word", "bits"])

    return run


def encode_level(keys: DataFrame, n: int, seed: int) -> Level:
    """A Bloom filter over ``keys`` (h1, h2); bits are combined on the executors, its words come to the driver."""
    per_key, hashes = (10, 7) if seed == 0 else (2, 1)
    size = -(-max(1024, per_key * n) // 64) * 64
    words = keys.select("h1", "h2").mapInArrow(_bits(size, hashes, seed), "word long, bits long")
    packed = np.zeros(size // 64, np.int64)
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    packed[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return Level(packed.view(np.uint8), size, hashes, seed)


def cascade(universe: DataFrame, flag: str, max_megabytes: int = MAX_MEGABYTES) -> list[Level]:
    """Levels for the keys of ``universe`` (h1, h2, flag) whose flag is set; none set: no level."""
    sides = [universe.where(F.col(flag)).select("h1", "h2"), universe.where(~F.col(flag)).select("h1", "h2")]
    counts = [sides[0].count(), None]
    levels: list[Level] = []
    n = counts[0]
    for i in range(MAX_LEVELS):
        if not n:
            return levels
        if sum(x.size for x in levels) + 10 * n > max_megabytes * 8_000_000:
            raise ValueError(f"the cascade for {n} keys exceeds {max_megabytes} MB; raise max_megabytes or split the list by host")
        levels.append(encode_level(sides[i % 2], n, i))
        level = levels[-1]

        @F.pandas_udf("boolean")
        def wrong(h1: pd.Series, h2: pd.Series) -> pd.Series:
            return pd.Series(passes(h1.to_numpy(), h2.to_numpy(), level))

        # Keys of the other side that this level lets through are what the next one encodes.
        other = (i + 1) % 2
        sides[other] = written(sides[other].where(wrong("h1", "h2")), "cascade")
        n = sides[other].count()
    raise RuntimeError(f"no exact cascade after {MAX_LEVELS} levels")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], listed: DataFrame, max_megabytes: int = MAX_MEGABYTES) -> DataFrame:
    """pages (page_id, url) -> page_id, host, path, rule, verdict for every row.

    rules: (verdict, host, path); a rule fits its host and all subdomains if the path starts with
    its path; the longest wins. Urls that no rule fits are blocked if their host, or a domain above
    it, is listed (column ``key``), else allowed. Null urls or urls without ``://`` have empty host
    and path and are allowed. Repeated rows are each judged; an empty table gives no rows. The levels are
    sent to every executor: a list that needs more than ``max_megabytes`` is refused, not cut.
    """
    spark = pages.sparkSession
    small_arrow_batches(spark, rows=5000)
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    label_counts = sorted({r[0] for r in listed.select(F.size(F.split("key", r"\.")).alias("n")).distinct().collect()})
    shapes = sorted({(h.count(".") + 1, len(p)) for _, h, p in rules} | {(n, 0) for n in label_counts})
    rows = rows.withColumn("keys", keys_of(F.col("host"), F.col("path"), shapes))

    def hashed(df: DataFrame) -> DataFrame:
        return df.withColumns({"h1": F.xxhash64("key"), "h2": F.xxhash64(F.lit(1), "key")})

    named = spark.createDataFrame([(h + p, v == "allow", v == "block") for v, h, p in rules], "key string, allow boolean, block boolean")
    named = named.union(listed.select("key", F.lit(False), F.lit(True)))
    plain = rows.select(F.explode("keys").alias("key")).distinct().select("key", F.lit(False).alias("allow"), F.lit(False).alias("block"))
    universe = hashed(plain.union(named)).groupBy("h1", "h2").agg(F.max("allow").alias("allow"), F.max("block").alias("block"))
    universe = written(universe, "url-keys")
    shared = spark.sparkContext.broadcast((cascade(universe, "allow", max_megabytes), cascade(universe, "block", max_megabytes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allow, block = shared.value
        for batch in batches:
            keys = batch.column("keys")
            at = np.asarray(keys.offsets)
            h1, h2 = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("h1s", "h2s"))
            allowed, blocked = member(h1, h2, allow), member(h1, h2, block)
            flat = keys.flatten().to_pylist()
            at = at - at[0]
            rule, verdict = [], []
            for i in range(batch.num_rows):
                hits = [j for j in range(at[i], at[i + 1]) if allowed[j] or blocked[j]]
                own = next((j for j in hits if "/" in flat[j]), None)
                rule.append(None if own is None else flat[own])
                verdict.append("allow" if (allowed[own] if own is not None else not hits) else "block")
            yield pa.record_batch([*batch.columns[:3], pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                                  names=["page_id", "host", "path", "rule", "verdict"])

    hashes = rows.withColumns({"h1s": F.transform("keys", lambda k: F.xxhash64(k)), "h2s": F.transform("keys", lambda k: F.xxhash64(F.lit(1), k))})
    return hashes.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")


def url_report(pages: DataFrame, listed: DataFrame | None = None, max_megabytes: int = MAX_MEGABYTES) -> DataFrame:
    """Judge every page by the fixed rules and a list of hosts (column ``key``; default: listed_hosts); odd rows as in judge."""
    return judge(pages, RULES, listed_hosts(pages) if listed is None else listed, max_megabytes)
