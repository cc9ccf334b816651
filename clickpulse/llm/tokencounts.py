"""Token counts: an exact histogram of encoded lengths and what it answers for every context limit."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import running_sums, small_arrow_batches, written

RANKS_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public pre-tokenisation pattern that goes with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE = 500_000  # spaced words a worker remembers
LONGEST = 64  # characters of a word that is remembered

_TWO_WHITE = re.compile(r"\s\s")
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")


def read_ranks(path: str = RANKS_PATH) -> dict[bytes, int]:
    """Read the vocabulary on the driver; it travels to the tasks (its size is fixed)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Lengths(dict):
    """Number of tokens of a space and a word; words of one worker are counted once."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> int:
        n = len(self.encode(" " + word))
        if len(word) <= LONGEST:
            if len(self) >= CACHE:
                self.clear()
            self[word] = n
        return n


def token_count(text: str | None, lengths: Lengths) -> int:
    """Tokens of the whole text; null and empty: 0.

    The pattern always ends a token before a single space between two other characters, so the
    counts of the parts add up.
    """
    if not text:
        return 0
    parts = text.split(" ") if not _TWO_WHITE.search(text) else _SAFE_CUT.split(text)
    first = len(lengths.encode(parts[0]))
    return first + sum(map(lengths.__getitem__, parts[1:]))


def token_lengths(docs: DataFrame, path: str = RANKS_PATH) -> DataFrame:
    """docs (text) -> n_tokens, one row per row."""
    spark = docs.sparkSession
    small_arrow_batches(spark)
    shared = spark.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoding = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=shared.value, special_tokens={})
        lengths = Lengths(encoding.encode_ordinary)
        for batch in batches:
            yield pa.record_batch([pa.array([token_count(t.as_py(), lengths) for t in batch.column(0)], pa.int64())], names=["n_tokens"])

    return docs.select("text").mapInArrow(run, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """n_tokens -> n_tokens, documents: one row per distinct length."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("documents"))


def limit_answers(histogram: DataFrame, limits: DataFrame | None = None) -> DataFrame:
    """What a context of ``n_tokens`` tokens keeps, for every length of the histogram and every row of ``limits`` (n_tokens).

    documents (of exactly that length), at_most and longer (documents up to it, and beyond),
    share (at_most of all: the quantile that the length is), tokens (in documents up to it),
    kept_tokens (all documents cut to it), lost_tokens. Repeated limits count once; an empty
    histogram answers with zeros and a null share.
    """
    rows = histogram
    if limits is not None:
        rows = rows.union(limits.select(F.col("n_tokens").cast("long"), F.lit(0).cast("long"))).groupBy("n_tokens").agg(F.sum("documents").alias("documents"))
    rows = written(rows, "length-histogram")
    n, total = rows.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum(F.col("documents") * F.col("n_tokens")), F.lit(0))).first()
    run = running_sums(rows, [F.col("n_tokens")], {"at_most": F.col("documents"), "tokens": F.col("documents") * F.col("n_tokens")}, "length-sums")
    longer = F.lit(n) - F.col("at_most")
    kept = F.col("tokens") + F.col("n_tokens") * longer
    return run.select("n_tokens", "documents", "at_most", longer.alias("longer"), F.try_divide(F.col("at_most"), F.lit(float(n))).alias("share"),
                      "tokens", kept.alias("kept_tokens"), (F.lit(total) - kept).alias("lost_tokens"))


def quantile(answers: DataFrame, q: float) -> DataFrame:
    """The smallest length that at least a share ``q`` of the documents does not exceed (one row; null if there are none)."""
    return answers.where(F.col("share") >= q).agg(F.min("n_tokens").alias("n_tokens"))


def token_report(docs: DataFrame) -> DataFrame:
    return limit_answers(length_histogram(token_lengths(docs)))
