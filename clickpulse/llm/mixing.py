"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame functions only).

Every document gets an exponential key, -ln(u) / quality, so within a source the order of the
keys is a weighted sample without replacement. Sizes are summed along that order; a source takes
its whole documents as often as its target holds its total (complete epochs) and then those first
in the order whose running total comes nearest to the rest of the target (fractional selection).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import WORD_PATTERN, running_sums, uniform, written

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CAP = 2
SEED = 17
# Quality of labelled documents as a sampling weight; documents without a label weigh 1.
QUALITY = {1: 2.0, 0: 0.5}


def quality_weights(labels: DataFrame, quality: dict[int, float] = QUALITY) -> DataFrame:
    """labels (doc_id, quality) -> doc_id, weight: by the highest label of a document."""
    best = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("q"))
    weight = F.lit(1.0)
    for q, w in quality.items():
        weight = F.when(F.col("q") == q, F.lit(w)).otherwise(weight)
    return best.select("doc_id", weight.alias("weight"))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, mark: runs of non-white characters in the whole text (null: 0), a hash of the text."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id"), F.col("source"), size.alias("size"), F.xxhash64("text").alias("mark"))


def keyed(rows: DataFrame, weights: DataFrame, seed: int = SEED) -> DataFrame:
    """Rows with their exponential key; ``weights`` (doc_id, weight) may miss documents (weight 1).

    A row's draw depends on its doc_id, or, without one, on its text.
    """
    w = weights.select(F.col("doc_id").alias("_id"), F.col("weight").alias("_weight"))
    out = rows.join(w, rows["doc_id"] == w["_id"], "left")
    draw = F.when(F.col("doc_id").isNull(), uniform(seed, F.col("doc_id"), F.col("mark"))).otherwise(uniform(seed, F.col("doc_id")))
    return out.select(*rows.columns, (-F.log(draw) / F.coalesce("_weight", F.lit(1.0))).alias("key"))


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """sources (source, source_size) -> source, source_size, target, epochs, rest.

    Sources in code point order, null last, take ``weights`` in turn. ``budget`` times all sizes is
    shared by weight; a target stops at ``cap`` times its source and the excess is shared again,
    which is target = min(cap * size, level * weight) for one level. The level is read off running
    sums over the sources in the order of cap * size / weight.
    """
    ranked = running_sums(sources, [F.asc_nulls_last("source")], {"n": F.lit(1)}, "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("n") - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = written(ranked.select("source", "source_size", weight.alias("w"), (F.col("source_size") * F.lit(float(cap))).alias("most")), "source-weights")
    total, all_w = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0.0))).first()
    rated = rows.withColumn("ratio", F.col("most") / F.col("w"))
    run = running_sums(rated, [F.col("ratio").asc(), F.asc_nulls_last("source")], {"most_sum": F.col("most"), "w_sum": F.col("w")}, "source-levels")
    level = (F.lit(budget * total) - (F.col("most_sum") - F.col("most"))) / (F.lit(all_w) - (F.col("w_sum") - F.col("w")))
    first = run.select("ratio", level.alias("level")).where("level <= ratio").agg(F.min_by("level", "ratio")).first()[0]
    share = F.col("most") if first is None else F.least("most", F.lit(first) * F.col("w"))
    out = rows.select("source", "source_size", share.alias("target"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    return out.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))


def mixture(rows: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> tuple[DataFrame, DataFrame]:
    """rows (doc_id, source, size, key) -> (rows, plan); plan has one row per source.

    plan: source, source_size, target, epochs, last (the greatest place() that the fractional
    selection takes, null if none), equals and total (how many of the rows at that place it takes, of how
    many). A document is taken ``epochs`` times, and once more if it comes before ``last`` or is one of ``equals`` there.
    """
    order = [F.asc_nulls_last("source"), F.asc("key"), F.asc_nulls_last("doc_id"), F.asc("mark"), F.asc("size")]
    run = written(running_sums(rows, order, {"upto": F.col("size")}, "mix-order"), "mix-sums")
    per_source = run.groupBy("source").agg(F.sum("size").alias("source_size"), F.min(F.col("upto") - F.col("size")).alias("start"))
    plan = written(targets(per_source.select("source", "source_size"), weights, budget, cap), "mix-targets")
    starts = per_source.select(F.col("source").alias("_s"), "start")
    full = plan.join(starts, F.col("source").eqNullSafe(F.col("_s"))).select(F.col("source").alias("_s"), "rest", "start")
    near = run.join(full, F.col("source").eqNullSafe(F.col("_s"))).where(
        F.col("upto") - F.col("size") - F.col("start") + F.col("size") / 2 <= F.col("rest")).where("size > 0")
    # The last place first, then how many rows stand there and how many of them are taken: all combine before the shuffle.
    last = near.groupBy(F.col("source").alias("_s")).agg(F.max(place()).alias("last"))
    ends = full.join(last.withColumnRenamed("_s", "_l"), F.col("_s").eqNullSafe(F.col("_l"))).drop("_l")
    there = run.join(ends, F.col("source").eqNullSafe(F.col("_s"))).where(place() == F.col("last"))
    inside = F.col("upto") - F.col("size") - F.col("start") + F.col("size") / 2 <= F.col("rest")
    equals = there.groupBy("_s").agg(F.first("last").alias("last"), F.count_if(inside).alias("equals"), F.count("*").alias("total"))
    plan = plan.join(equals, F.col("source").eqNullSafe(F.col("_s")), "left").select("source", "source_size", "target", "epochs", "last", "equals", "total")
    return rows, written(plan, "mix-plan")


def place():
    """Where a document stands in its source's order; rows equal in all of these are copies of one document."""
    return F.struct(F.col("key").alias("key"), F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), F.col("mark").alias("mark"), F.col("size").alias("size"))


def copies(rows: DataFrame, weights: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with key, source_size, target and ``copies``, how often the mix takes the document (0 up).

    Where only some of the rows at a source's last place are taken, which are copies of one document, these
    rows alone are numbered; they are picked out before the keys are joined, so other texts move once.
    """
    split = plan.where("equals < total").select(F.col("source").alias("_s"), F.col("last.mark").alias("_mark"), F.col("last.size").alias("_size"))
    spot = F.col("source").eqNullSafe(F.col("_s")) & (F.col("mark") == F.col("_mark")) & (F.col("size") == F.col("_size"))
    plain = [*rows.columns, "key", "source_size", "target"]

    def placed(part: DataFrame) -> DataFrame:
        own = keyed(part, weights)
        p = plan.withColumnRenamed("source", "_s")
        return own.join(p, own["source"].eqNullSafe(p["_s"])).drop("_s")

    numbered = (F.col("equals") < F.col("total")) & (place() == F.col("last"))
    every = placed(rows).where(~F.coalesce(numbered, F.lit(False)))
    every = every.select(*plain, (F.col("epochs") + F.coalesce((place() <= F.col("last")).cast("long"), F.lit(0))).alias("copies"))
    if split.isEmpty():  # one row per source
        return every
    tied = placed(rows.join(split, spot, "left_semi")).where(numbered).withColumn("_row", F.monotonically_increasing_id())
    tied = running_sums(tied, [F.asc_nulls_last("source"), F.col("_row")], {"_nth": F.lit(1)}, "mix-ties")
    first = tied.groupBy(F.col("source").alias("_f")).agg(F.min("_nth").alias("_first"))
    tied = tied.join(first, F.col("source").eqNullSafe(F.col("_f")))
    tied = tied.select(*plain, (F.col("epochs") + (F.col("_nth") - F.col("_first") < F.col("equals")).cast("long")).alias("copies"))
    return every.unionByName(tied)


def mix_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document.

    Null text has size 0; a null source is a source of its own, last in order; an empty table gives
    no rows; documents of size 0 are taken with 0 words. Rows without a doc_id are drawn by their
    text; of repeated rows as many are taken as the target needs.
    """
    slim, weights = written(sized(docs), "mix-rows"), quality_weights(labels)
    _, plan = mixture(keyed(slim, weights))
    return copies(slim, weights, plan).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it, columns unchanged, whatever their names.

    Odd rows are treated as in mix_report. An empty table gives no rows.
    """
    rows = written(keyed(sized(docs), quality_weights(labels)), "mix-rows")
    _, plan = mixture(rows)
    # The decision is a function of a document's own key and its source's row: the texts are not sorted.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("doc_id"), F.col("source"),
                        F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"), F.xxhash64("text").alias("mark"))
    taken = copies(whole, quality_weights(labels), plan)
    return taken.where("copies > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
