"""Exact top-k inner products over a pivot-distance index.

Vectors are lifted to equal length (one more component), so a larger inner product is a smaller
distance. The index keys every vector by its nearest pivot and its distance to it and keeps it in
blocks: rings (annuli) of one pivot, sorted by distance, of bounded size. A query first reads the ring
nearest to it, which gives a radius; then it expands to those rings that the triangle inequality
does not place beyond the radius, and to no others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickpulse.llm.common import small_arrow_batches, written

PIVOTS = 64
SAMPLE = 2048  # rows the pivots are chosen from: those with the smallest hashes
RING = 512  # vectors in a block
TOGETHER = 128  # queries handed to a block at once
SLACK = 1e-6


def integer_vectors(rows: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, v array<long>) of floor(scale * x); null or non-finite vectors and null ids go, repeated rows count once."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).distinct()


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first choice: each pivot is the sampled point farthest from those before it."""
    chosen = [0]
    far = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(sample)):
        i = int(far.argmax())
        if far[i] == 0:
            break
        chosen.append(i)
        far = np.minimum(far, ((sample - sample[i]) ** 2).sum(axis=1))
    return sample[chosen]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as int64, shorter ones padded with zeros."""
    flat, at = column.flatten().to_numpy(), np.asarray(column.offsets)
    at = at - at[0]
    if len(flat) == dim * len(column) and (np.diff(at) == dim).all():
        return flat.reshape(len(column), dim)
    out = np.zeros((len(column), dim), np.int64)
    for i in range(len(column)):
        out[i, : at[i + 1] - at[i]] = flat[at[i]:at[i + 1]]
    return out


def _lift(v: np.ndarray, most: float) -> np.ndarray:
    x = v.astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(0.0, most - (x * x).sum(axis=1)))[:, None]])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * x @ pivots.T))


def _assign(pivots: np.ndarray, most: float, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = _distances(_lift(_matrix(batch.column(1), dim), most), pivots)
            cell = d.argmin(axis=1) if len(d) else np.empty(0, np.int64)
            yield pa.record_batch([*batch.columns, pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell], pa.float64())],
                                  names=["vec_id", "v", "cell", "dist"])

    return run


def _rings(dim: int, ring: int):
    """Rows sorted by (cell, dist) -> blocks of one cell: bounds, ids and vectors in bytes."""

    def block(cell, rows):
        ids, dist, v = zip(*rows)
        m = np.zeros((len(v), dim), np.int64)
        for i, x in enumerate(v):
            m[i, : len(x)] = x
        return int(cell), float(dist[0]), float(dist[-1]), len(ids), np.array(ids, np.int64).tobytes(), m.tobytes()

    def emit(blocks):
        cols = list(zip(*blocks)) or [()] * 6
        kinds = [pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.binary(), pa.binary()]
        return pa.record_batch([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=["cell", "lo", "hi", "n", "ids", "vectors"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []
        for batch in batches:
            done = []
            for i, v, c, d in zip(*[x.to_pylist() for x in batch.columns]):
                if rows and (c != cell or len(rows) >= ring):
                    done.append(block(cell, rows))
                    rows = []
                cell = c
                rows.append((i, d, v))
            yield emit(done)
        yield emit([block(cell, rows)] if rows else [])

    return run


def _query_cells(pivots: np.ndarray, dim: int):
    """A query's distance to every pivot (at most PIVOTS rows each), with its squared length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(1), dim).astype(np.float64)
            d = _distances(np.hstack([v, np.zeros((len(v), 1))]), pivots)
            p = d.shape[1]
            yield pa.record_batch([pa.array(np.repeat(np.asarray(batch.column(0)), p), pa.int64()), pa.array(np.tile(np.arange(p), len(v)), pa.int32()),
                                   pa.array(d.ravel(), pa.float64()), pa.array(np.repeat((v * v).sum(axis=1), p), pa.float64())],
                                  names=["query_id", "cell", "d", "length2"])

    return run


def _score(k: int, dim: int):
    """(queries of a block as lists, the block) -> each query's best k of that block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q_out, v_out, s_out = [], [], []
            for qs, vs, ids, vectors in zip(*[batch.column(c) for c in ("queries", "query_vectors", "ids", "vectors")]):
                q, own = np.array(qs.as_py(), np.int64), np.frombuffer(ids.as_py(), np.int64)
                a, b = _matrix(vs.values, dim), np.frombuffer(vectors.as_py(), np.int64).reshape(-1, dim)
                bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * dim
                # Products are exact in doubles below 2^53, else in 64-bit integers.
                s = (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64) if bound < 2**53 else a @ b.T
                for i in range(len(q)):
                    free = np.flatnonzero(own != q[i])
                    top = free[np.lexsort((own[free], -s[i, free]))[:k]]
                    q_out.append(np.full(len(top), q[i]))
                    v_out.append(own[top])
                    s_out.append(s[i, top])
            cat = lambda x: pa.array(np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64), pa.int64())
            yield pa.record_batch([cat(q_out), cat(v_out), cat(s_out)], names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, pivots: int = PIVOTS, sample: int = SAMPLE, ring: int = RING) -> DataFrame:
    """vectors (vec_id, v), queries (query_id, v): query_id, rank, vec_id, score of each query's k highest products.

    A query meets every vector but those of its own id; ties go to the smaller vec_id; fewer than k
    are returned where there are fewer. Vectors of different length are compared as if padded with
    zeros. Empty inputs give no rows. Vectors so long that a product might not fit 64-bit integers
    (a squared length of 2^62 or more) are an error.
    """
    spark = vectors.sparkSession
    small_arrow_batches(spark, rows=256, megabytes=8)
    vectors = written(vectors, "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, dim, most = vectors.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.coalesce(F.max(norm), F.lit(0.0))).first()
    out = "query_id long, rank int, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], out)
    if most >= 2.0**62:
        raise ValueError("vectors are too long: inner products would not fit 64-bit integers")
    dim = max(1, dim)
    # The pivots come from a bounded sample; every vector is indexed.
    some = vectors.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(sample).select("v").collect()
    points = np.zeros((len(some), dim), np.int64)
    for i, r in enumerate(some):
        points[i, : len(r["v"])] = r["v"]
    centres = choose_pivots(_lift(points, most), pivots)

    keyed = vectors.mapInArrow(_assign(centres, most, dim), "vec_id long, v array<long>, cell int, dist double")
    sorted_rows = keyed.repartitionByRange("cell", "dist", "vec_id").sortWithinPartitions("cell", "dist", "vec_id")
    packed = sorted_rows.select("vec_id", "v", "cell", "dist").mapInArrow(_rings(dim, ring), "cell int, lo double, hi double, n int, ids binary, vectors binary")
    blocks = written(packed.withColumn("block", F.xxhash64("cell", "lo", "ids")), "rings")

    asked = written(queries.select(F.col("query_id").cast("long").alias("query_id"), "v").distinct(), "queries")
    reach = asked.mapInArrow(_query_cells(centres, dim), "query_id long, cell int, d double, length2 double")
    reach = written(reach, "reach")
    rings = blocks.select("cell", "lo", "hi", "n", "block")
    # Triangle inequality: nothing in the ring, or in the whole cell, is nearer to the query than this.
    nearest = F.greatest(F.lit(0.0), F.col("d") - F.col("hi"), F.col("lo") - F.col("d"))
    cells = written(rings.groupBy("cell").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("in_cell")), "cells")
    in_reach = reach.join(F.broadcast(cells), "cell").withColumn("nearest", nearest).drop("lo", "hi")  # one row per pivot

    def evaluate(pairs: DataFrame) -> DataFrame:
        """Best k of every (query, block) pair, then of every query; queries meet a block in bounded lists."""
        with_v = pairs.join(asked, "query_id").withColumn("part", F.xxhash64("query_id") % F.greatest(F.lit(1), F.ceil(F.lit(len_asked / TOGETHER))))
        lists = with_v.groupBy("block", "part").agg(F.collect_list(F.struct("query_id", "v")).alias("all"))
        lists = lists.select("block", F.col("all.query_id").alias("queries"), F.col("all.v").alias("query_vectors"))
        met = lists.join(blocks.select("block", "ids", "vectors").hint("merge"), "block").select("queries", "query_vectors", "ids", "vectors")
        return met.mapInArrow(_score(k, dim), "query_id long, vec_id long, score long")

    len_asked = asked.count()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # The first ring lies in the query's own cell; the radius it gives closes whole cells before any of their rings is listed.
    home = in_reach.groupBy("query_id").agg(F.min(F.struct((F.col("in_cell") <= k).alias("few"), "d", "cell")).alias("at"))
    own = home.select("query_id", "at.cell", "at.d").join(rings, "cell").withColumn("nearest", nearest)
    first = own.groupBy("query_id").agg(F.min(F.struct((F.col("n") <= k).alias("few"), "nearest", "block")).alias("at"))
    first = written(first.select("query_id", F.col("at.block").alias("block")), "first-ring")
    near = written(evaluate(first).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "first-scores")
    kth = near.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
    radius = F.sqrt(F.greatest(F.lit(0.0), F.col("length2") + F.lit(float(most)) - 2.0 * F.col("kth").cast("double")))
    reached = F.col("kth").isNull() | (F.col("nearest") <= radius + SLACK * (radius + 1))
    open_cells = in_reach.join(first.withColumnRenamed("block", "seen"), "query_id").join(kth, "query_id", "left").where(reached)
    open_rings = open_cells.drop("nearest").join(rings.hint("merge"), "cell").withColumn("nearest", nearest).where(reached & (F.col("block") != F.col("seen")))
    found = near.select("query_id", "vec_id", "score").union(evaluate(open_rings.select("query_id", "block")))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def search_report(embeddings: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """Queries: rows whose vec_id is divisible by ``every``; candidates: every row but the query's own."""
    vectors = integer_vectors(embeddings)
    queries = vectors.where(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), "v")
    return top_k(vectors, queries, k)
