"""SimHash near-duplicates by multi-index hashing.

One pass over the whole texts gives each document a 64-bit fingerprint: a bit is set if over half of
its word shingles' hashes have it. Two fingerprints within two bits agree up to one bit in one of
their two 32-bit halves, so a table holds every distinct fingerprint under both of its halves and
each fingerprint looks up the ball of radius one around its halves there (of two halves one bit
apart only the one that lacks the bit looks up the other). Whole distances of all matches decide.

A half that many distinct fingerprints share would make all pairs among them candidates. Lookups
that meet such a bucket go another way that finds the same links: the ball of radius two around
the whole fingerprint, whose 2,080 keys are looked up in the list of distinct fingerprints. So a
fingerprint never costs more than a fixed number of rows, whatever the buckets hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import small_arrow_batches, written
from clickpulse.llm.components import connected_components
from clickpulse.operators.joins import materialized_side

SEED = 42
DISTANCE = 2
BUCKET = 256  # distinct fingerprints that share a half, beyond which lookups take the whole ball
LIST_BYTES = 8 << 20  # bytes on disk up to which the list of large buckets is broadcast


def shingle_hashes(text: bytes | None, k: int = 3) -> np.ndarray:
    """XXH64 of every k-word shingle, repeats included; fewer words: the whole sequence is one; none: empty."""
    words = text.lower().split() if text else []  # bytes: A-Z only, ASCII white space only
    n = max(len(words) - k + 1, min(1, len(words)))
    runs = zip(*[words[i:] for i in range(k)]) if len(words) >= k else [words]
    return np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(SEED)), np.uint64, n) if n else np.empty(0, np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have, as a signed 64-bit number; no hashes: 0."""
    ones = np.zeros(64, np.int64)
    raw = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    for i in range(0, len(raw), 1 << 15):  # a long text never unpacks whole
        ones += np.unpackbits(raw[i:i + (1 << 15)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, fp long: one row per row, of the whole text."""
    small_arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(shingle_hashes(t.as_py(), words)) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, fp long")


def _halves(fp: Column) -> Column:
    """Both halves as table keys: the half and, above its 32 bits, which one it is."""
    low = fp.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.array(low, F.shiftrightunsigned(fp, 32).bitwiseOR(F.lit(1 << 32)))


def close_pairs(fps: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """``fps`` (fp long, distinct, not null) -> u, v: all pairs that differ in 1 to ``distance`` (at most 2) bits.

    A pair may come more than once and in either order.
    """
    if not 1 <= distance <= 2:
        raise ValueError("two halves and balls of radius one find distances of 1 and 2")
    table = fps.select(F.explode(_halves(F.col("fp"))).alias("key"), F.col("fp").alias("v"))
    ball = F.expr("concat(array(named_struct('key', key, 'same', true)), transform(filter(sequence(0, 31), b -> shiftright(key, b) % 2 = 0), "
                  "b -> named_struct('key', key | shiftleft(1L, b), 'same', false)))")
    probes = table.select("v", F.explode(ball).alias("p")).select(F.col("p.key").alias("key"), F.col("p.same").alias("same"), F.col("v").alias("u"))
    apart = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    # The list of large buckets holds at most 2/bucket keys per fingerprint: broadcast only if its files are small.
    large = materialized_side(table.groupBy("key").count().where(F.col("count") > bucket).select("key"), LIST_BYTES)
    plain = probes.join(large, "key", "left_anti").join(table.hint("merge"), "key").where(~F.col("same") | (F.col("u") < F.col("v")))
    whole = F.expr("flatten(transform(sequence(0, 63), i -> transform(sequence(i, 63), j -> u ^ (shiftleft(1L, i) | shiftleft(1L, j)))))")
    around = probes.join(large, "key", "left_semi").select("u").distinct().select("u", F.explode(whole).alias("v"))
    found = around.join(fps.select(F.col("fp").alias("v")).hint("merge"), "v").select("u", "v")
    return plain.select("u", "v").union(found).where((apart > 0) & (apart <= distance))


def simhash_groups(docs: DataFrame, words: int = 3, distance: int = DISTANCE) -> DataFrame:
    """``docs`` (doc_id, text, ...) -> doc_id, fp, component_id: one row per row.

    Rows whose fingerprints differ in at most ``distance`` bits are linked; ``component_id`` is the
    smallest doc_id reachable. Null, empty and blank texts have the fingerprint 0 and are linked
    like any other. Each row is judged by its own text, also where rows share a doc_id. Rows without
    a doc_id link like others; a component without any doc_id has a null id. Repeated rows come
    back as often as they are given; an empty table gives no rows; other columns are not read.
    """
    sketch = written(fingerprints(docs, words), "simhash")
    # Copies end here: every later step sees each fingerprint once.
    classes = written(sketch.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    found = connected_components(close_pairs(classes.select("fp"), distance), "simhash-links")
    root = F.coalesce("component", "fp")
    placed = classes.join(found.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").select("fp", "first", root.alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    # Both sides of the last join are plain tables, so a fingerprint with many documents is split.
    where = written(placed.join(least, "root").select("fp", "component_id"), "simhash-components")
    return sketch.join(where.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def simhash_report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every document; see simhash_groups for odd rows."""
    return simhash_groups(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
