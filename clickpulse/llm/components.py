"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import files_for, written


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def large_star(edges: DataFrame, files: int | None = None) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (itself included)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least", files)
    return _oriented(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def small_star(edges: DataFrame, files: int | None = None) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them (edges hold u > v)."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "least", files)
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _oriented(moved.union(least.select("u", F.col("m").alias("v"))))


def connected_components(edges: DataFrame, name: str = "components", max_rounds: int = 64, files: int | None = None) -> DataFrame:
    """``edges`` (u long, v long) -> (node, component): the smallest node reachable, for every node of an edge.

    Each round is two aggregations and two joins on the node; minima are combined before the
    shuffle, so a hub costs one row per task there, and they are written, so that both sides of the
    join are plain tables and Spark can split a hub's rows. The edges of a round are written once, and
    two scalars (count, sum of hashes) tell the driver when nothing changed; the count, which no round
    raises, gives the number of files of a round's tables, and ``files`` that of the given edges. Loops,
    repeated and null edges are ignored; no edges give no rows.
    """
    now = written(_oriented(edges.select("u", "v").where("u is not null and v is not null")), name, files)

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    last = state(now)
    few = files_for(last[0])
    for _ in range(max_rounds if last[0] else 0):
        now = written(small_star(large_star(now, few), few), name, few)
        here = state(now)
        if here == last:
            break
        last = here
    else:
        if last[0]:
            raise RuntimeError(f"no stable components after {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
