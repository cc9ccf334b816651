"""Lempel-Ziv phrase fingerprints: the hashed phrases of an LZ78 parse, kept as their smallest hashes.

Texts that a compressor's dictionary would help each other with share phrases, so the likeness of
two phrase sets, estimated from their minimum hashes, follows compression similarity.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import small_arrow_batches

SIGNATURE = 128  # smallest phrase hashes kept


class Parse:
    """An LZ78 parse that can be fed in parts and forked between them.

    ``phrases`` is the dictionary, ``open`` the phrase read so far (in the dictionary already), and
    ``hashes`` the phrases' hashes, computed once for what a fork shares.
    """

    __slots__ = ("phrases", "open", "hashes")

    def __init__(self):
        self.phrases, self.open, self.hashes = set(), "", []

    def fork(self) -> Parse:
        other = Parse()
        other.phrases, other.open, other.hashes = set(self.phrases), self.open, list(self.hashes)
        return other

    def feed(self, text: str) -> None:
        phrases, phrase, fresh = self.phrases, self.open, []
        add = phrases.add
        for c in text:
            phrase += c
            if phrase not in phrases:
                add(phrase)
                fresh.append(phrase)
                phrase = ""
        self.open = phrase
        self.hashes.append(np.fromiter(map(xxhash.xxh3_64_intdigest, fresh), np.uint64, len(fresh)))

    def signature(self) -> np.ndarray:
        """The smallest hashes of the phrases, sorted."""
        x = np.concatenate([*self.hashes, np.empty(0, np.uint64)])
        return np.sort(np.partition(x, SIGNATURE)[:SIGNATURE] if len(x) > SIGNATURE else x)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness from two signatures: shared share of the smallest hashes of both together; two empty: 1."""
    both = np.union1d(a, b)[:SIGNATURE]
    if not len(both):
        return 1.0
    return float(np.intersect1d(np.intersect1d(a, b, assume_unique=True), both, assume_unique=True).size / len(both))


def fingerprint(text: str) -> np.ndarray:
    p = Parse()
    p.feed(text)
    return p.signature()


def as_text(signature: np.ndarray) -> str:
    return signature.astype(">u8").tobytes().hex()


def _one(doc, following):
    """Result of a document given the next one: (id, text, parse of its first part, whole signature)."""
    doc_id, text, head, own = doc
    _, next_text, _, next_own = following
    n = len(text)
    cut = n - n // 3
    tail = next_text[: n // 3]
    head.feed(tail)
    edited = head.signature()
    digest = hashlib.sha256((text[:cut] + tail).encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, n, digest, as_text(own), as_text(edited), likeness(own, edited), likeness(own, next_own)


def _read(doc_id, text):
    text = text or ""
    parse = Parse()
    cut = len(text) - len(text) // 3
    parse.feed(text[:cut])
    head = parse.fork()  # the edited text starts with the same part
    parse.feed(text[cut:])
    return doc_id, text, head, parse.signature()


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in descending order, the guest (first of the next slice) last: each document waits for the next one."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    before = None
    for batch in batches:
        out = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            here = _read(doc_id, text.as_py())
            if before is not None:
                out.append(_one(before, here))
            before = here
        yield pa.record_batch([pa.array([r[i] for r in out], t) for i, t in enumerate(_TYPES)], names=names)


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """documents (doc_id, text) -> per row its fingerprint, the edited text's and both likenesses.

    The edited text has its last third (rounded down) replaced by the first as many characters of
    the next document in descending doc_id; after the last comes the first. Null ids come last,
    rows with one id follow a hash of their text; null text counts as empty; one row alone is its
    own next document; an empty table gives no rows.

    Documents are dealt out by range of the id, one slice per shuffle partition, each text once;
    the first row of a slice also goes to the slice before it. Slices are read in order, one
    document at a time.
    """
    spark = docs.sparkSession
    small_arrow_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    slices = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = rows.agg(F.approx_percentile("doc_id", [i / slices for i in range(1, slices)] or [0.5], 10 * max(1000, slices))).first()[0]
    cuts = sorted(set(cuts or ()), reverse=True)
    # Slice of an id: how many cuts are above or at it, from the highest id down; null ids in the last one.
    slice_of = F.when(F.col("doc_id").isNull(), F.lit(len(cuts))) if cuts else F.lit(0)
    if cuts:
        up = F.lit(sorted(cuts))
        slice_of = slice_of.otherwise(F.size(F.filter(up, lambda c: c > F.col("doc_id"))))
    tie = F.xxhash64("text")
    order = F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), F.col("doc_id").isNotNull().alias("has"), tie.alias("tie"))
    placed = rows.withColumn("slice", slice_of.cast("int")).withColumn("place", order)
    firsts = sorted(((r["slice"], tuple(r["first"])) for r in placed.groupBy("slice").agg(F.max("place").alias("first")).collect()), reverse=True)
    if not firsts:
        return spark.createDataFrame([], SCHEMA)
    # At most one entry per slice: which row opens a slice, and the slice in front of it that reads it as a guest.
    order_of = sorted(s for s, _ in firsts)
    ahead = {s: order_of[i - 1] for i, s in enumerate(order_of)}  # the first slice opens the last one's next
    opens = spark.createDataFrame([(s, ahead[s], *p) for s, p in firsts], "slice int, ahead int, id long, has boolean, tie long")
    opens = F.broadcast(opens.select(F.struct("id", "has", "tie").alias("place"), "ahead"))
    guests = placed.join(opens, "place").select(F.col("ahead").alias("slice"), "place", F.lit(1).alias("guest"), "doc_id", "text").dropDuplicates(["slice"])
    every = placed.select("slice", "place", F.lit(0).alias("guest"), "doc_id", "text").union(guests)
    dealt = every.repartitionById(slices, F.col("slice")).sortWithinPartitions("slice", "guest", F.desc("place"))
    return dealt.select("doc_id", "text").mapInArrow(_chain, SCHEMA)
