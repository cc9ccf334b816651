"""Cross-entropy difference scoring with matched target and background character models.

Both models are trigram models over code points with one shared vocabulary, counted over whole
texts: the target on documents of labelled quality, the background on all others, its counts scaled
down to the mass of the target.
A document's score is its mean loss per character under the target less that under the background;
lower is more like the target.

No model is broadcast. Documents are dealt out in blocks of about equally many characters; a block
first lists its distinct trigrams with their counts, the counts of all blocks give the losses, and each
block then joins just the losses that it needs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import small_arrow_batches, written
from clickpulse.operators.joins import materialized_side

BLOCK_CHARS = 4_000_000  # characters in a block, about
TARGET_BYTES = 8 << 20  # bytes on disk up to which the list of targets is broadcast
PRIOR = 20.0  # weight of the shorter context in each estimate
CHUNK = 2_000_000  # characters handled at once
START = 0x1FFFFF  # stands before a text, twice
BITS = 21
LOW1, LOW2 = (1 << BITS) - 1, (1 << 2 * BITS) - 1


def block_of(doc_id: Column, text: Column, blocks: int) -> Column:
    """Block of a document by its id and text, so that neither a hot id nor rows without one fill a block."""
    return F.pmod(F.xxhash64(doc_id, text), F.lit(blocks))


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed trigram of every character of every text, and the number of trigrams per text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    joined = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    padded = np.full(len(joined) + 2 * len(texts), START, np.int64)
    at = np.arange(len(joined)) + 2 * (np.repeat(np.arange(len(texts)), sizes) + 1)
    padded[at] = joined
    return padded[at - 2] << 2 * BITS | padded[at - 1] << BITS | joined, sizes


def _chunks(texts: list[str]):
    """Ranges of texts of about CHUNK characters."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= CHUNK:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _count(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
    texts = [t or "" for t in docs.column("text").to_pylist()]
    target = docs.column("target").to_numpy(zero_copy_only=False).astype(bool)
    background = ~target
    keys, counts = np.empty(0, np.int64), np.empty((0, 2), np.int64)
    for a, b in _chunks(texts):
        grams, sizes = trigrams(texts[a:b])
        grams = np.concatenate([keys, grams])
        add = np.stack([np.repeat(target[a:b], sizes), np.repeat(background[a:b], sizes)], axis=1).astype(np.int64)
        add = np.concatenate([counts, add])
        keys, at = np.unique(grams, return_inverse=True)
        counts = np.stack([np.bincount(at, add[:, j], len(keys)) for j in (0, 1)], axis=1).astype(np.int64)
    block = key[0].as_py()
    return pa.table({"block": pa.array(np.full(len(keys), block), pa.int64()), "gram": pa.array(keys, pa.int64()),
                     "t": pa.array(counts[:, 0], pa.int64()), "b": pa.array(counts[:, 1], pa.int64())})


def _score(key, docs: pa.Table, losses: pa.Table) -> pa.Table:
    grams = losses.column("gram").to_numpy()
    order = np.argsort(grams)
    grams, loss = grams[order], np.stack([losses.column(c).to_numpy()[order] for c in ("loss_t", "loss_b")])
    texts = [t or "" for t in docs.column("text").to_pylist()]
    sums, sizes = np.zeros((2, len(texts))), np.array([len(t) for t in texts], np.int64)
    for a, b in _chunks(texts):
        found, n = trigrams(texts[a:b])
        if not len(found):
            continue
        here, back = np.unique(found, return_inverse=True)
        at = np.searchsorted(grams, here)[back]
        owner = np.repeat(np.arange(a, b), n)
        for j in (0, 1):
            sums[j] += np.bincount(owner, loss[j, at], len(texts))
    empty = sizes == 0
    mean = [np.divide(s, sizes, out=np.zeros(len(s)), where=~empty) for s in sums]
    return pa.table({"doc_id": docs.column("doc_id"), "n_tokens": pa.array(sizes, pa.int64()),
                     "target_loss": pa.array(mean[0], pa.float64(), mask=empty), "background_loss": pa.array(mean[1], pa.float64(), mask=empty),
                     "score": pa.array(mean[0] - mean[1], pa.float64(), mask=empty)})


def losses(counts: DataFrame, prior: float = PRIOR, scale: float = 1.0) -> DataFrame:
    """counts (gram, t, b) over the corpus -> gram, loss_t, loss_b in bits; every b counts ``scale`` times.

    Each order is smoothed with the next shorter one: (n + prior * shorter) / (n of context + prior);
    single characters with 1 / (vocabulary + 1) added once each, the vocabulary being all characters
    of the corpus.
    """
    total = [F.sum("t").alias("t"), F.sum("b").alias("b")]
    part = {"t": F.lit(1.0), "b": F.lit(float(scale))}
    low1, low2 = F.lit(LOW1), F.lit(LOW2)
    two = counts.groupBy(F.col("gram").bitwiseAND(low2).alias("two")).agg(*total)
    two = written(two, "bigrams")
    one = two.groupBy(F.col("two").bitwiseAND(low1).alias("one")).agg(*total)
    n_t, n_b, size = one.agg(F.coalesce(F.sum("t"), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0)), F.count("*")).first()
    one = one.select("one", *[((F.col(c) * part[c] + 1) / F.lit(float(n + size + 1))).alias(f"p_{c}") for c, n in (("t", n_t), ("b", n_b * scale))])
    before1 = two.groupBy(F.shiftright("two", BITS).alias("ctx")).agg(F.sum("t").alias("c_t"), F.sum("b").alias("c_b"))
    smooth = lambda c: ((F.col(c) * part[c] + F.lit(prior) * F.col(f"p_{c}")) / (F.col(f"c_{c}") * part[c] + F.lit(prior)))
    two_p = two.withColumn("one", F.col("two").bitwiseAND(low1)).join(one, "one").join(before1, F.shiftright("two", BITS) == F.col("ctx"))
    two_p = two_p.select("two", smooth("t").alias("p_t"), smooth("b").alias("p_b"))
    before2 = counts.groupBy(F.shiftright("gram", BITS).alias("ctx")).agg(F.sum("t").alias("c_t"), F.sum("b").alias("c_b"))
    three = counts.withColumn("two", F.col("gram").bitwiseAND(low2)).join(two_p, "two").join(before2, F.shiftright("gram", BITS) == F.col("ctx"))
    return three.select("gram", (-F.log2(smooth("t"))).alias("loss_t"), (-F.log2(smooth("b"))).alias("loss_b"))


def cross_entropy_difference(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """docs (doc_id, text), targets (doc_id) -> doc_id, n_tokens, target_loss, background_loss, score; one row per row.

    Losses are mean bits per character; null or empty texts have 0 tokens and null losses. Without
    targets the target model is uniform over the vocabulary; an empty table gives no rows; repeated
    rows are each counted and scored; other columns are not read.

    The background is counted on all documents that are no target. The models are matched in mass: if
    it has more characters than the target, its counts are scaled down.
    """
    small_arrow_batches(docs.sparkSession)
    # The list of targets grows with the labels: broadcast while its files are small, else the texts are shuffled once by id.
    hit = materialized_side(targets.select(F.col("doc_id").cast("long").alias("_target")).where("_target is not null").distinct(), TARGET_BYTES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sizes = rows.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n")).join(hit, F.col("doc_id") == F.col("_target"), "left")
    zero = F.lit(0)
    in_target, others = sizes.agg(F.coalesce(F.sum(F.when(F.col("_target").isNotNull(), F.col("n"))), zero),
                                  F.coalesce(F.sum(F.when(F.col("_target").isNull(), F.col("n"))), zero)).first()
    rate = 1.0 if not in_target else min(1.0, in_target / max(1, others))
    blocks = max(1, -(-(in_target + others) // BLOCK_CHARS))
    placed = rows.withColumn("block", block_of(F.col("doc_id"), F.col("text"), blocks))
    flagged = placed.join(hit, F.col("doc_id") == F.col("_target"), "left").select("block", "text", F.col("_target").isNotNull().alias("target"))
    grams = written(flagged.groupBy("block").applyInArrow(_count, "block long, gram long, t long, b long"), "block-trigrams")
    counts = written(grams.groupBy("gram").agg(F.sum("t").alias("t"), F.sum("b").alias("b")), "trigrams")
    # Written, so that both sides are plain tables and a trigram that is in every block can be split.
    needed = grams.select("block", "gram").join(written(losses(counts, scale=rate), "losses").hint("merge"), "gram")
    return placed.groupBy("block").cogroup(needed.groupBy("block")).applyInArrow(
        _score, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")


def lm_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Target: documents labelled of quality, background: all others; score every document; odd rows as above."""
    return cross_entropy_difference(docs, labels.where("quality = 1").select("doc_id"))
