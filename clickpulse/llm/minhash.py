"""MinHash near-duplicates: hash minima, banding, verification, connected components.

Per document one pass over the whole text gives its set of word shingles (64-bit hashes), the
minima of many universal hash functions, and band keys. Documents with the same set form a class,
and only one text of each class goes on. Classes that share a band key are candidates. A
member is first compared with the bucket's first one with which it shares most buckets, by signature,
then on the full sets. Buckets whose members are then still in several components are compared
within, in blocks of bounded size, and only between components. Blocks emit only
links that join two parts, never all pairs. Components of the confirmed links are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import files_for, small_arrow_batches, written
from clickpulse.llm.components import connected_components

HASHES = 384  # universal hash functions per signature
MISS = 1e-6  # highest chance that banding misses a pair right at the threshold
BLOCK = 256  # rows of one side of a comparison block
MARGIN = 0.2  # a pair whose signatures agree in less than threshold - MARGIN is not checked in full
SURROGATE = 1 << 62  # ids from here on stand for rows without a doc_id

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def band_rows(threshold: float, hashes: int = HASHES, miss: float = MISS) -> int:
    """The most rows per band that keep the chance of missing a pair at the threshold under ``miss``."""
    rows = 1
    for r in range(1, hashes + 1):
        if (1 - threshold**r) ** (hashes // r) <= miss:
            rows = r
    return rows


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; fewer words: the whole sequence is one; none: empty."""
    words = text.lower().split() if text else []  # bytes: A-Z only, ASCII white space only
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(k, n)
    acc = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        acc = _mixed(acc * _MIX[0] + h[i:n - width + 1 + i])
    return np.unique(acc)


def hash_family(hashes: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    return (rng.integers(0, 1 << 32, hashes, np.uint32) | np.uint32(1))[:, None], rng.integers(0, 1 << 32, hashes, np.uint32)[:, None]


def minima(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each function a * x + b (mod 2^32) its minimum over the set (not empty)."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    a, b = family
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):
        np.minimum(out, (a * x[None, i:i + 1024] + b).min(axis=1), out=out)
    return out


def _sketches(k: int, hashes: int, rows: int):
    bands = hashes // rows
    family = hash_family(hashes)
    seeds = _mixed(np.arange(1, bands + 1, dtype=np.uint64) * _MIX[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, found = [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(2)):
                s = shingle_hashes(text.as_py(), k)
                sizes.append(len(s))
                if not len(s):
                    keys.append(b"empty" + i.to_bytes(8, "little", signed=True))
                    found.append(None)
                    continue
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                m = minima(s, family)[: bands * rows].reshape(bands, rows).astype(np.uint64)
                acc = seeds.copy()
                for j in range(rows):
                    acc = _mixed(acc * _MIX[0] + m[:, j])
                found.append(acc.view(np.int64))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                                   pa.array(found, pa.list_(pa.int64()))], names=["id", "mark", "n_shingles", "set_key", "bands"])

    return run


def _sets(k: int, hashes: int):
    family = hash_family(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, signs = [], []
            for text in batch.column(1):
                s = shingle_hashes(text.as_py(), k)
                sets.append(s.tobytes())
                signs.append((minima(s, family) & np.uint32(255)).astype(np.uint8).tobytes())
            yield pa.record_batch([batch.column(0), pa.array(sets, pa.binary()), pa.array(signs, pa.binary())], names=["node", "hashes", "sig"])

    return run


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on sorted distinct hashes."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _star(percent: int):
    """Pairs (u, v) with their sets -> whether they match."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = percent / 100 - MARGIN
        for batch in batches:
            linked = []
            for h, s, fh, fs in zip(*[batch.column(c) for c in ("hashes", "sig", "first_hashes", "first_sig")]):
                near = (np.frombuffer(s.as_py(), np.uint8) == np.frombuffer(fs.as_py(), np.uint8)).mean() >= floor
                linked.append(bool(near) and _similar(np.frombuffer(h.as_py(), np.uint64), np.frombuffer(fh.as_py(), np.uint64), percent))
            yield pa.record_batch([batch.column("u"), batch.column("v"), pa.array(linked, pa.bool_())], names=["u", "v", "linked"])

    return run


def block_links(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Links that join components within one block; rows: (node, part, component so far, hashes, sig).

    Part 0 is the component of the bucket's first member; parts 1 and 2 are open. Open rows are compared
    with all rows of part 0, or, if there are none, those of part 1 with those of part 2 (or with each
    other, if the block holds one part). A pair that is joined already is skipped.
    """
    floor = percent / 100 - MARGIN
    parts = {p: [r for r in rows if r[1] == p] for p in (0, 1, 2)}
    left = parts[1]
    right = parts[0] or parts[2] or parts[1]
    if not left or not right:
        return []
    sig = np.stack([np.frombuffer(r[4], np.uint8) for r in right])
    sets = [np.frombuffer(r[3], np.uint64) for r in right]
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.get(x, x) != x:
            x = up[x] = up.get(up[x], up[x])
        return x

    out = []
    for own, _, part_of, own_set, own_sig in left:
        own_set = np.frombuffer(own_set, np.uint64)
        agree = (sig == np.frombuffer(own_sig, np.uint8)).mean(axis=1)
        for j in np.argsort(-agree, kind="stable"):
            if agree[j] < floor:
                break
            if root(part_of) != root(right[j][2]) and _similar(own_set, sets[j], percent):
                up[root(part_of)] = root(right[j][2])
                out.append((own, right[j][0]))
    return out


def _blocks(percent: int):
    """Rows sorted by block -> links; holds the rows of one block (at most a few hundred) at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def done(found):
            return pa.record_batch([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["u", "v"])

        for batch in batches:
            found = []
            for *here, node, part, component, h, s in zip(*[c.to_pylist() for c in batch.columns]):
                if here != key:
                    found += block_links(rows, percent)
                    key, rows = here, []
                rows.append((node, part, component, h, s))
            yield done(found)
        yield done(block_links(rows, percent))

    return run


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, hashes: int = HASHES, block: int = BLOCK) -> DataFrame:
    """``docs`` (id long not null, text) -> (id, mark, n_shingles, component, grp): one row per row of ``docs``.

    Two documents are linked if 100 * intersection >= percent * union of their distinct
    ``shingle_words``-word shingles (A-Z lower-cased; fewer words: the whole sequence is the one
    shingle). ``component`` is the smallest id reachable, ``grp`` the component's own number, ``mark``
    a hash of the row's text. Empty sets (null or blank text) are linked with nothing. Rows that share
    an id are each judged by their own text: a link is between texts, never between ids. An empty table
    gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    small_arrow_batches(spark)
    rows = band_rows(percent / 100, hashes)
    source = docs.select(F.col("id").cast("long").alias("id"), F.xxhash64("text").alias("mark"), F.col("text").cast("binary").alias("text"))
    sketch = written(source.mapInArrow(_sketches(shingle_words, hashes, rows), "id long, mark long, n_shingles long, set_key binary, bands array<long>"), "sketch")
    few = files_for(sketch.count())  # files of the narrow tables below

    # Classes of equal sets; one text of each, that of the smallest id, goes on under the class's number.
    classes = sketch.groupBy("set_key").agg(F.min(F.struct("id", "mark")).alias("rep"), F.first("bands").alias("bands"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    keys = classes.where("bands is not null").select(F.explode("bands").alias("band"), "node")
    shared = keys.groupBy("band").agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1")
    shared = written(shared, "buckets", few)
    in_buckets = files_for(shared.agg(F.sum("n")).first()[0] or 0)  # files of tables with a row per member
    # Members of buckets; a hot bucket is one key of a plain join, which Spark can split.
    member = written(keys.join(shared.select("band", "first").hint("merge"), "band"), "members", in_buckets)

    # Each member meets the first one that it shares most buckets with: a near copy, if it has one.
    often = member.where("node <> first").groupBy("node", "first").agg(F.count("*").alias("n"))
    pairs = often.groupBy(F.col("node").alias("u")).agg(F.max_by("first", F.struct("n", -F.col("first"))).alias("v"))
    pairs = written(pairs, "star-pairs", few)

    # The list of members grows with the corpus: never broadcast it, at any size.
    wanted = member.select("node").distinct().join(classes.select("node", "rep.id", "rep.mark"), "node")
    chosen = source.join(wanted.hint("merge"), ["id", "mark"]).select("id", "mark", "node", "text").dropDuplicates(["id", "mark"])
    sets = written(chosen.select("node", "text").mapInArrow(_sets(shingle_words, hashes), "node long, hashes binary, sig binary"), "sets")
    first_sets = sets.join(pairs.select(F.col("v").alias("node")).distinct(), "node", "left_semi")
    first_sets = first_sets.select(F.col("node").alias("v"), F.col("hashes").alias("first_hashes"), F.col("sig").alias("first_sig"))
    star = pairs.join(sets.withColumnRenamed("node", "u").hint("merge"), "u").join(first_sets.hint("merge"), "v")
    star = star.select("u", "v", "hashes", "sig", "first_hashes", "first_sig").mapInArrow(_star(percent), "u long, v long, linked boolean")
    links = written(star.where("linked").select("u", "v"), "star", few)

    # Buckets whose members are still in several components: compare those outside the first one's with all others.
    sofar = written(connected_components(links, "star-links", files=few), "star-components", few)
    of = lambda c: sofar.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in"))
    placed = member.join(of("node").hint("merge"), "node", "left").join(of("first").hint("merge"), "first", "left").select(
        "band", "node", F.coalesce("node_in", "node").alias("component"), F.coalesce("first_in", "first").alias("home"))
    placed = written(placed.withColumn("joined", F.col("component") == F.col("home")), "placed", in_buckets)
    size = placed.groupBy("band").agg(F.count_if("joined").alias("n_in"), F.count_if(~F.col("joined")).alias("n_open")).where("n_open > 0")
    size = written(size.select("band", F.ceil(F.col("n_in") / block).cast("int").alias("in_cuts"), F.ceil(F.col("n_open") / block).cast("int").alias("open_cuts")), "open", few)
    spots = placed.join(size.hint("merge"), "band").select(
        "band", "node", "component", "joined", "in_cuts", "open_cuts",
        F.pmod(F.xxhash64("node"), F.when(F.col("joined"), F.col("in_cuts")).otherwise(F.col("open_cuts"))).cast("int").alias("cut"))
    here = F.col("cut")
    settled = F.transform(F.sequence(F.lit(0), F.col("open_cuts") - 1), lambda o: F.struct(o.alias("a"), F.lit(0).alias("kind"), here.alias("b"), F.lit(0).alias("part")))
    to_in = F.transform(F.sequence(F.lit(0), F.col("in_cuts") - 1), lambda c: F.struct(here.alias("a"), F.lit(0).alias("kind"), c.alias("b"), F.lit(1).alias("part")))
    to_open = F.transform(F.sequence(F.lit(0), F.col("open_cuts") - 1), lambda o: F.struct(
        F.least(here, o).alias("a"), F.lit(1).alias("kind"), F.greatest(here, o).alias("b"), F.when(here <= o, F.lit(1)).otherwise(F.lit(2)).alias("part")))
    dealt = spots.select("band", "node", "component", F.explode(F.when(F.col("joined"), settled).otherwise(F.concat(to_in, to_open))).alias("at"))
    dealt = dealt.select("band", "at.a", "at.kind", "at.b", "node", "at.part", "component").join(sets.hint("merge"), "node")
    dealt = dealt.select("band", "a", "kind", "b", "node", "part", "component", "hashes", "sig")
    by = ["band", "a", "kind", "b"]
    more = dealt.repartition(*by).sortWithinPartitions(*by, "part", "node").mapInArrow(_blocks(percent), "u long, v long")

    found = connected_components(links.union(more), "links", files=few).select("node", F.col("component").alias("root"))
    reps = classes.select("set_key", "node", "rep.id").join(found, "node", "left").select("set_key", "id", F.coalesce("root", "node").alias("grp"))
    least = reps.groupBy("grp").agg(F.min("id").alias("component"))
    reps = written(reps.join(least, "grp").select("set_key", "grp", "component"), "group-of-set", few)
    return sketch.select("id", "mark", "n_shingles", "set_key").join(reps.hint("merge"), "set_key").select("id", "mark", "n_shingles", "component", "grp")


def document_ids(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> id, text: doc_id, or for rows without one a number from the text (equal texts share it)."""
    stand_in = F.lit(SURROGATE) + F.xxhash64("text").bitwiseAND(F.lit(SURROGATE - 1))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), stand_in).alias("id"), "text")


def near_duplicate_report(docs: DataFrame, shingle_words: int = 3, percent: int = 85) -> DataFrame:
    """``documents`` -> doc_id, n_shingles, component_id (smallest doc_id reachable), kept (its own component).

    A row without doc_id is linked like any other; a component without any doc_id has a null id,
    and its rows count as kept. Rows that share a doc_id each have the component of their own text.
    """
    found = near_duplicates(document_ids(docs), shingle_words, percent)
    real = lambda c: F.when(F.col(c) < F.lit(SURROGATE), F.col(c))
    return found.select(real("id").alias("doc_id"), "n_shingles", real("component").alias("component_id"),
                        (F.col("id") == F.col("component")).alias("kept"))


def one_of_each_group(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` (columns unchanged, whatever their names) of every group of near-duplicate texts.

    It is the row of the group's smallest id; of rows that share it, one text of the group, and of
    repeated rows one. Every text without words is a group of its own per id. An empty table gives no rows.
    """
    found = near_duplicates(document_ids(docs), shingle_words, percent)
    kept = written(found.groupBy("grp").agg(F.min(F.struct("id", "mark")).alias("rep")).select("rep.id", "rep.mark").distinct(), "kept")
    # One struct holds the given columns, so no name of theirs can clash.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("doc_id"), F.col("text"))
    stand_in = F.lit(SURROGATE) + F.xxhash64("text").bitwiseAND(F.lit(SURROGATE - 1))
    whole = whole.select("doc", F.coalesce(F.col("doc_id").cast("long"), stand_in).alias("id"), F.xxhash64("text").alias("mark"))
    # Both sides grow with the corpus: a merge join at any size. Repeated rows end in a partial aggregate.
    rows = whole.join(kept.hint("merge"), ["id", "mark"])
    return rows.groupBy("id", "mark").agg(F.first("doc").alias("doc")).select("doc.*")
