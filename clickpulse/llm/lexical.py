"""Ranked lexical search by pipelined term partitioning.

The terms of all items are dealt to owners, rare ones first, by equal shares of the work. Postings are
kept by owner and by shard, a hash of the document. An item's bundle (its terms and, per shard, a
sparse set of documents with their scores so far) passes through the owners one after the other; at
each a cogroup brings it together with that owner's postings of the shard, and integer
contributions are added. A document leaves a bundle only when what it has plus the most that the
owners to come can add stays below the shard's k-th best score so far, so the best k stay exact.
After the last owner the best of each shard are ranked together.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickpulse import storage
from clickpulse.llm.common import running_sums, small_arrow_batches, written
from clickpulse.operators.joins import materialized_side
from clickpulse.session import scratch_dir

TOP = 20
OWNERS = 4  # stages of the pipeline
SHARD_DOCS = 1 << 14  # documents, and
SHARD_POSTINGS = 1 << 20  # postings of a shard, about
LANE_ITEMS = 1024  # items that one group holds at most, about
FILTER_BYTES = 8 << 20  # bytes on disk up to which the list of terms goes to the workers as a first filter

# Bytes that belong to terms (digits, letters, all of a multi-byte character), A-Z in lower case; all others end a term.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TERM_BYTES).split() if text else []


def term_rows(rows: DataFrame, key: str, only: DataFrame | None = None) -> DataFrame:
    """``rows`` (key, text) with at least one term -> row (unique), key, n (terms with repeats), terms, counts; written.

    ``only`` (term): terms that are wanted. It is a first filter; terms beyond it may come through when it is large.
    """
    spark = rows.sparkSession
    small_arrow_batches(spark)
    wanted = spark.sparkContext.broadcast(frozenset(r[0].encode() for r in only.collect())) if only is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = wanted.value if wanted else None
        for batch in batches:
            ids, sizes, terms, counts, ends = [], [], [], [], [0]
            for i, text in zip(batch.column(0), batch.column(1)):
                found = terms_of(text.as_py())
                if found:
                    seen = Counter(found if known is None else filter(known.__contains__, found))
                    ids.append(i.as_py())
                    sizes.append(len(found))
                    terms += [t.decode() for t in seen]
                    counts += seen.values()
                    ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.string())),
                                   pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))], names=[key, "n", "terms", "counts"])

    picked = rows.select(F.col(key).cast("long").alias(key), F.col("text").cast("binary").alias("text"))
    out = picked.mapInArrow(run, f"`{key}` long, n long, terms array<string>, counts array<long>")
    return written(out.withColumn("row", F.monotonically_increasing_id()), "term-rows")


def _impact(docs: int, length: int) -> Column:
    """(1000000000 * tf) div (1000 * tf + 12 * m) of a posting (tf, n)."""
    m = F.lit(75) + F.expr(f"(25 * n * {docs}L) div {max(1, length)}L")
    return F.call_function("div", F.lit(1_000_000_000) * F.col("tf"), F.lit(1000) * F.col("tf") + F.lit(12) * m)


def term_owners(postings: DataFrame, wants: DataFrame, docs: int, owners: int) -> DataFrame:
    """postings (term, impact), wants (term, lane, item) -> term, tid, owner, w, most (the largest contribution), lanes.

    Owners get equal shares of the additions to be made, in the order of rising document frequency.
    """
    stats = postings.groupBy("term").agg(F.count("*").alias("df"), F.max("impact").alias("most"))
    asked = wants.groupBy("term").agg(F.count("*").alias("items"), F.sort_array(F.collect_set("lane")).alias("lanes"))
    w = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * docs + 2.0) / (F.lit(2.0) * F.col("df") + F.lit(1.0)))).cast("long")
    rows = stats.join(asked, "term").select("term", "df", "lanes", w.alias("w"), (w * F.col("most")).alias("most"), (F.col("df") * F.col("items")).alias("work"))
    run = written(running_sums(rows, [F.col("df"), F.col("term")], {"tid": F.lit(1), "upto": F.col("work")}, "term-order"), "term-sums")
    total = run.agg(F.coalesce(F.sum("work"), F.lit(1))).first()[0]
    owner = F.least(F.lit(owners - 1), F.floor(F.lit(owners) * (F.col("upto") - F.col("work")) / F.lit(total))).cast("int")
    return run.select("term", "tid", owner.alias("owner"), "w", "most", "lanes")


BUNDLE = "shard int, lane int, item long, plan array<struct<owner:int,tid:long,times:long,most:long>>, docs array<struct<row:long,id:long>>, scores array<long>"


def _flat_docs(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A list column of (row, id) -> list bounds, rows, ids (null: the largest number)."""
    lists = column.combine_chunks()
    values = lists.flatten()
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    rows, ids = values.field("row"), values.field("id")
    return np.concatenate([[0], sizes.cumsum()]), rows.to_numpy(zero_copy_only=False).astype(np.int64), ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


_NO_ID = np.iinfo(np.int64).max
_PLAN = pa.list_(pa.struct([("owner", pa.int32()), ("tid", pa.int64()), ("times", pa.int64()), ("most", pa.int64())]))


def visit(owner: int, last: bool, top: int):
    """One stage: bundles of a shard meet the owner's postings of that shard."""

    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        bounds, rows, ids = _flat_docs(bundles.column("docs"))
        scores = bundles.column("scores").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        tid, row, adds = (postings.column(c).to_numpy().astype(np.int64) for c in ("tid", "row", "adds"))
        doc = postings.column("id").combine_chunks()
        doc = (doc.combine_chunks() if isinstance(doc, pa.ChunkedArray) else doc).fill_null(_NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(tid, kind="stable")
        tid, row, adds, doc = tid[order], row[order], adds[order], doc[order]
        every, first = np.unique(np.concatenate([rows, row]), return_index=True)
        id_of = np.concatenate([ids, doc])[first]
        at, carried = np.searchsorted(every, row), np.searchsorted(every, rows)
        plans = bundles.column("plan").to_pylist()
        docs_out, scores_out, ends = [], [], [0]
        for k, plan in enumerate(plans):
            total = np.zeros(len(every), np.int64)
            total[carried[bounds[k]:bounds[k + 1]]] = scores[bounds[k]:bounds[k + 1]]
            rest = 0
            for t in plan or ():
                if t["owner"] == owner:
                    a, b = np.searchsorted(tid, [t["tid"], t["tid"] + 1])
                    total[at[a:b]] += adds[a:b] * t["times"]  # a term has one posting per row
                elif t["owner"] > owner:
                    rest += t["most"] * t["times"]
            live = np.flatnonzero(total)
            if len(live) > top:
                bar = np.partition(total[live], len(live) - top)[len(live) - top]
                live = live[total[live] + rest >= bar]
            if last:
                live = live[np.lexsort((every[live], id_of[live], -total[live]))[:top]]
            docs_out.append(live)
            scores_out.append(total[live])
            ends.append(ends[-1] + len(live))
        kept = np.concatenate(docs_out) if docs_out else np.empty(0, np.int64)
        own = id_of[kept]
        pair = pa.StructArray.from_arrays([pa.array(every[kept], pa.int64()), pa.array(own, pa.int64(), mask=own == _NO_ID)], names=["row", "id"])
        offsets = pa.array(ends, pa.int32())
        values = pa.array(np.concatenate(scores_out) if scores_out else kept, pa.int64())
        out = [*[bundles.column(c) for c in ("shard", "lane", "item")], bundles.column("plan").cast(_PLAN)]
        return pa.table([*out, pa.ListArray.from_arrays(offsets, pair), pa.ListArray.from_arrays(offsets, values)],
                        names=["shard", "lane", "item", "plan", "docs", "scores"])

    return run


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, owners: int = OWNERS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """``docs`` (doc_id, text, ...) and ``items`` (item_id, text, ...) -> item_id, rank, doc_id, score.

    The ``top`` highest-scoring documents of each item with a score above 0, ties by ascending doc_id
    (null last). Every row is a document of its own and every row of ``items`` an item of its own, also
    where ids repeat or are null. Rows without a term (null, empty, no letter or digit) neither count
    nor match. Empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    asked = term_rows(items, "item_id")
    lanes = max(1, -(-asked.count() // LANE_ITEMS))
    lane = F.pmod(F.xxhash64("row"), F.lit(lanes)).cast("int")
    wants = written(asked.select(F.col("row").alias("item"), "item_id", lane.alias("lane"), F.inline(F.arrays_zip("terms", "counts"))).withColumnsRenamed(
        {"terms": "term", "counts": "times"}), "item-terms")

    path = scratch_dir(spark, "wanted-terms")
    wants.select("term").distinct().write.parquet(path)
    wanted = spark.read.schema("term string").parquet(path)
    # Beyond the bound the workers filter nothing and the join below, then a shuffle, does it alone.
    found = term_rows(docs, "doc_id", wanted if storage.size_of(spark, path) <= FILTER_BYTES else None)
    n_docs, length = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")

    posted = found.select("row", F.col("doc_id").alias("id"), "n", F.inline(F.arrays_zip("terms", "counts"))).withColumnsRenamed({"terms": "term", "counts": "tf"})
    posted = posted.withColumn("impact", _impact(n_docs, length))
    terms = materialized_side(term_owners(posted, wants, n_docs, owners))
    n_posted = found.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    shards = max(1, -(-n_docs // shard_docs), -(-n_posted // SHARD_POSTINGS))
    shard = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard")
    place = scratch_dir(spark, "postings")
    (posted.join(terms, "term").select(shard, F.explode("lanes").alias("lane"), "tid", "row", "id", (F.col("w") * F.col("impact")).alias("adds"), "owner")
     .write.partitionBy("owner").parquet(place))
    postings = spark.read.schema("shard int, lane int, tid long, row long, id long, adds long, owner int").parquet(place)

    plans = wants.join(terms, "term").groupBy("item", "lane").agg(F.collect_list(F.struct("owner", "tid", "times", "most")).alias("plan"))
    bundles = plans.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "lane", "item", "plan",
                           F.expr("CAST(array() AS array<struct<row:long,id:long>>)").alias("docs"), F.expr("CAST(array() AS array<long>)").alias("scores"))
    by = ["shard", "lane"]
    for k in range(owners):
        here = postings.where(F.col("owner") == k).drop("owner")
        bundles = bundles.groupBy(*by).cogroup(here.groupBy(*by)).applyInArrow(visit(k, k == owners - 1, top), BUNDLE)

    best = bundles.select("item", F.inline(F.arrays_zip("docs", "scores"))).select("item", "docs.row", "docs.id", F.col("scores").alias("score"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(asked.select(F.col("row").alias("item"), "item_id"), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def search_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Each item's 20 best documents; see ranked_search for odd rows."""
    return ranked_search(docs, items)
