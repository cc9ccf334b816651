"""Cross-tokenizer alignment on distinct texts.

Documents are shuffled by their full text, so each distinct text is tokenised and aligned once, with
the number of documents that hold it. Byte offsets where tokens of both vocabularies end cut a text
into groups; every pair of tokens of a group is a link. Pair counts are sums over distinct texts,
weighted by their multiplicity, and the measures of a text go back to its documents by its SHA-256.

Both tokenizers cut at a single space between two other characters, and before a single line feed
between two other characters, so a text is a row of such units and units that a worker remembers
are not tokenised again.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import small_arrow_batches, written
from clickpulse.operators.joins import materialized_side

BYTE_PATH = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CACHE_BYTES = 112 << 20  # of one generation of units that a worker remembers, by estimate
LONGEST = 64  # characters of a unit that is remembered
PAIR_BYTES = 16 << 20  # bytes on disk up to which the table of pair counts is broadcast

_TWO_WHITE = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?: (?=\S)|(?=\n\S))")
_PART = 40  # bits of each of the three numbers that a unit packs into one


def units_of(text: str) -> list[str]:
    """The text's units: each but the first follows a space that is left out, or begins with its line feed."""
    if _TWO_WHITE.search(text) or text[0].isspace() or text[-1].isspace():
        return _CUT.split(text)
    return text.replace("\n", " \n").split(" ")


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the units a worker remembers."""

    def __init__(self, byte_file: bytes, piece_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_file.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_file)
        alphabet = byte_alphabet()
        self.a_bytes: dict[int, bytes] = {i: bytes(alphabet[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        pieces = range(self.b.get_piece_size())
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace(MARK, " ").encode() for i in pieces]
        self.a_text, self.b_text = [str(i) for i in range(self.a.get_vocab_size())], [str(i) for i in pieces]
        self.mark = self.b.piece_to_id(MARK)
        self.young: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}
        self.held = 0

    def tokens(self, units: list[str], first: bool) -> Iterator[tuple[bytes, list[int], list[int]]]:
        """(bytes, A ids, B ids) of units; ``first``: of texts' beginnings, which follow a space even before a line feed."""
        after = [u[:1] == "\n" and not first for u in units]
        whole = [u if n else " " + u for u, n in zip(units, after)]
        for text, n, a, b in zip(whole, after, self.a.encode_batch_fast(whole, add_special_tokens=False), self.b.encode(units, num_threads=1)):
            yield text.encode(), a.ids, b[1:] if n and b[:1] == [self.mark] else b

    def aligned(self, text: bytes, a: list[int], b: list[int]) -> tuple | None:
        """(groups as text, link codes packed as uint32, (extra codes, counts) or None, packed sizes); None if the bytes differ."""
        one, two = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        if b"".join(one) != text or b"".join(two) != text:
            return None
        groups, codes, extra = [], [], []
        left_text, right_text = self.a_text, self.b_text
        i = j = 0
        n = len(a)
        while i < n:
            p, q, x, y = a[i], b[j], len(one[i]), len(two[j])
            i, j = i + 1, j + 1
            if x == y:
                groups.append(left_text[p] + "|" + right_text[q])
                codes.append(p << 16 | q)
                continue
            i0, j0 = i - 1, j - 1
            while x != y:
                if x < y:
                    x, i = x + len(one[i]), i + 1
                else:
                    y, j = y + len(two[j]), j + 1
            left, right = a[i0:i], b[j0:j]
            groups.append(",".join([left_text[p] for p in left]) + "|" + ",".join([right_text[q] for q in right]))
            if len(left) * len(right) <= 4096:
                codes += [p << 16 | q for p in left for q in right]
            else:  # by distinct ids: the occurrences of a long group are never listed
                p, np_ = np.unique(np.array(left, np.uint32), return_counts=True)
                q, nq = np.unique(np.array(right, np.uint32), return_counts=True)
                extra.append(((p[:, None] << np.uint32(16) | q).ravel(), np.outer(np_, nq).ravel()))
        return (";".join(groups), array("I", codes).tobytes(), extra or None, n | len(b) << _PART | len(groups) << 2 * _PART)

    def learn(self, units: set[str]) -> dict[str, tuple | None]:
        """Units missing in the young generation, from the older one or anew."""
        missing = [u for u in units if u not in self.young]
        found = {u: self.older[u] for u in missing if u in self.older}
        new = [u for u in missing if u not in found]
        found.update(zip(new, (self.aligned(*x) for x in self.tokens(new, False))))
        return found

    def remember(self, found: dict[str, tuple | None]) -> None:
        """Two generations, each bounded in bytes: a full one becomes the older."""
        kept = {u: x for u, x in found.items() if len(u) <= LONGEST}
        size = sum(320 + 2 * len(u) + (len(x[0]) + len(x[1]) if x else 0) for u, x in kept.items())
        if self.held + size > CACHE_BYTES:
            self.older, self.young, self.held = self.young, {}, 0
        self.young.update(kept)
        self.held += size

    def batch(self, texts: list[str]) -> list[tuple]:
        """Per text: n_a, n_b, n_groups, n_links, digest of the groups, pair codes, occurrences."""
        cut = [units_of(t) for t in texts]
        heads = [i for i, c in enumerate(cut) if c[0][:1] == "\n"]
        first = dict(zip(heads, (self.aligned(*x) for x in self.tokens([cut[i][0] for i in heads], True))))
        found = self.learn(set(chain.from_iterable(c[i in first:] for i, c in enumerate(cut))))
        young = self.young
        out = []
        for i, c in enumerate(cut):
            rows = [found[u] if u in found else young[u] for u in c[i in first:]]
            out.append(self.text_row([first[i], *rows] if i in first else rows))
        self.remember(found)
        return out

    @staticmethod
    def text_row(rows: list[tuple | None]) -> tuple:
        if None in rows:
            return 0, 0, 0, 0, "", _NO_CODES, _NO_COUNTS
        groups, codes, extra, sizes = zip(*rows)
        total = sum(sizes)
        part = (1 << _PART) - 1
        pairs, counts = np.unique(np.frombuffer(b"".join(codes), np.uint32), return_counts=True)
        more = list(chain.from_iterable(x for x in extra if x))
        if more:
            every = np.concatenate([pairs, *[x[0] for x in more]])
            pairs, at = np.unique(every, return_inverse=True)
            sums = np.zeros(len(pairs), np.int64)
            np.add.at(sums, at, np.concatenate([counts, *[x[1] for x in more]]))
            counts = sums
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        return total & part, total >> _PART & part, total >> 2 * _PART, int(counts.sum()), digest, pairs.view(np.int32), counts


_NO_CODES, _NO_COUNTS = np.empty(0, np.int32), np.empty(0, np.int64)
_ready: dict[bytes, Aligner] = {}


def aligner_of(byte_file: bytes, piece_file: bytes) -> Aligner:
    """The worker's aligner; it lives across tasks of one worker."""
    key = hashlib.sha256(byte_file + piece_file).digest()
    if key not in _ready:
        _ready.clear()
        _ready[key] = Aligner(byte_file, piece_file)
    return _ready[key]


ALIGNED = "copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes array<int>, occurrences array<long>"


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays) if arrays else [], kind))


def alignments(docs: DataFrame, byte_path: str = BYTE_PATH, piece_path: str = PIECE_PATH) -> DataFrame:
    """``docs`` (text) -> one row per distinct text that is not null or empty: row, key and ALIGNED.

    key: SHA-256 of the text; copies: documents that hold it; codes: its distinct linked pairs (A id
    in the upper, B id in the lower 16 bits) and how often each is linked in it. A text whose
    tokens do not spell it has zeros and no pairs. The vocabularies travel to the tasks (2 MB, fixed).
    """
    spark = docs.sparkSession
    small_arrow_batches(spark)
    with open(byte_path, "rb") as one, open(piece_path, "rb") as two:
        shared = spark.sparkContext.broadcast((one.read(), two.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(*shared.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            n_a, n_b, n_groups, n_links, digest, codes, counts = zip(*aligner.batch(batch.column(0).to_pylist()))
            yield pa.record_batch([batch.column(2), batch.column(1), *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)],
                                   pa.array(digest, pa.string()), _lists(codes, pa.int32()), _lists(counts, pa.int64())],
                                  names=["key", *[f.split()[0] for f in ALIGNED.split(", ")]])

    texts = docs.select("text").where("text is not null and text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    rows = texts.withColumn("key", F.sha2("text", 256)).mapInArrow(run, f"key string, {ALIGNED}")
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "alignments")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """alignments() -> code, n (documents that hold the pair linked), best (no other pair of its A id has more)."""
    counts = written(aligned.select("copies", F.explode("codes").alias("code")).groupBy("code").agg(F.sum("copies").alias("n")), "pair-counts")
    a_id = F.shiftrightunsigned("code", 16)
    most = counts.groupBy(a_id.alias("a_id")).agg(F.max("n").alias("most"))
    return counts.join(most, a_id == F.col("a_id")).select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def text_measures(aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """alignments() and pair_counts() -> per distinct text key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    # The pair table grows with the corpus, if slowly: broadcast it only if its files are small.
    side = materialized_side(pairs, PAIR_BYTES)
    links = aligned.select("row", F.inline(F.arrays_zip("codes", "occurrences"))).withColumnRenamed("codes", "code").join(side, "code")
    sums = links.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("occurrences")).otherwise(F.lit(0))).alias("n_best"),
                                    F.sum(F.col("occurrences") * F.col("n")).alias("count_sum"))
    none = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return aligned.drop("codes", "occurrences", "copies").join(sums, "row", "left").select(
        "key", "n_a", "n_b", "n_groups", "n_links", none("n_best"), none("count_sum"), "groups_sha256")


def alignment_report(docs: DataFrame, byte_path: str = BYTE_PATH, piece_path: str = PIECE_PATH) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per row of ``docs``.

    Null and empty texts, and texts that the tokens of either vocabulary do not spell, have zeros and
    an empty digest. Equal texts share all measures and count as often as they occur, whatever their
    doc_id (null too). An empty table gives no rows; other columns are not read.
    """
    aligned = alignments(docs, byte_path, piece_path)
    # Written, so that both sides of the last join are plain tables and a text with many documents is split.
    measures = written(text_measures(aligned, pair_counts(aligned)), "text-measures")
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2("text", 256).alias("key"))
    return whole.join(measures.hint("merge"), "key", "left").select(
        "doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers], F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
