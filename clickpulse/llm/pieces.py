"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is cut into marked words (white-space marks, then other characters); pieces never cross
such a border. The distinct marked words of a batch are sorted, which is the depth-first order of
their trie, and a forward pass keeps one state per character: words that share a prefix reuse its
states. The vocabulary is a byte-pair one, so the plain sum of scores does not give its encoding;
instead a step to a piece is admitted only if byte-pair merging of the pair (previous piece, piece)
gives that same pair. Exactly one path per prefix is admitted, and it is the merge result. The pieces
that end at a character come from an automaton over the vocabulary.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from typing import Any
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import small_arrow_batches

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CACHE_BYTES = 40 << 20  # of one generation of words that a worker remembers, by estimate
LONGEST = 64  # characters of a word that is remembered
PAIRS = 300_000  # pairs of pieces whose merging a worker remembers


@dataclass
class Vocabulary:
    """Plain pieces with id and score, the byte pieces, and the mark runs (longest first)."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes_: list[int]
    texts: list[bytes | None]  # what an id stands for; None: control
    runs: list[str]


@dataclass
class Encoder:
    """A vocabulary in a worker: automaton of the pieces of two characters or more, and what the worker remembers."""

    v: Vocabulary
    single: dict[str, int] = field(init=False)
    pairs: dict[int, bool] = field(default_factory=dict)
    words: dict[str, bytes] = field(default_factory=dict)
    older: dict[str, bytes] = field(default_factory=dict)  # the generation of words before
    held: int = 0

    def __post_init__(self):
        import ahocorasick

        self.single = {p: self.v.ids[p] for p in self.v.scores if len(p) == 1}
        self.piece = {self.v.ids[p]: p for p in self.v.scores}
        self.found = ahocorasick.Automaton()
        for p in self.v.scores:
            if len(p) > 1:
                self.found.add_word(p, (len(p), self.v.ids[p]))
        self.found.make_automaton()
        self.kind = "H" if len(self.v.texts) <= 1 << 16 else "I"

    def admitted(self, a: int, b: int) -> bool:
        """Whether byte-pair merging of two pieces' text gives these two; ``a`` -1: a character without a piece."""
        if a < 0:
            return True
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        x, y = self.piece[a], self.piece[b]
        ok = self.pairs[a << 32 | b] = merged(x + y, self.v) == [x, y]
        return ok


def read_vocabulary(path: str = MODEL_PATH) -> Vocabulary:
    """Read the model on the driver; its pieces travel to the tasks (about a megabyte, fixed by the model)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, scores, texts, bytes_, runs = {}, {}, [], [0] * 256, []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            bytes_[int(piece[3:5], 16)] = i
            texts.append(bytes([int(piece[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            texts.append(None)
        else:
            texts.append(piece.replace(MARK, " ").encode())
            ids[piece] = i
            if len(piece) > 1 and not piece.strip(MARK):
                runs.append(piece)
            else:
                scores[piece] = sp.get_score(i)
    return Vocabulary(ids, scores, bytes_, texts, sorted(runs, key=len, reverse=True))


def merged(text: str, v: Vocabulary) -> list[str]:
    """Byte-pair merging of a short string: the best-scored adjacent pair first, leftmost on ties."""
    parts = list(text)
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            s = v.scores.get(parts[i] + parts[i + 1])
            if s is not None and (best is None or s > best):
                best, at = s, i
        if at < 0:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


def encode_words(words: list[str], e: Encoder) -> dict[str, bytes]:
    """Packed ids of distinct marked words, visited in the depth-first order of their trie.

    ``last`` and ``size`` hold, per prefix length, the last piece of the prefix's encoding and its length.
    """
    out: dict[str, bytes] = {}
    v, known, single, matches = e.v, e.pairs, e.single, e.found.iter
    before, last, size = "", [-1], [0]
    for word in sorted(words):
        marks = len(word) - len(word.lstrip(MARK))
        lead = word[marks - 1:] if marks else word
        same, most = 0, min(len(lead), len(before))
        while same < most and lead[same] == before[same]:
            same += 1
        new = lead[same:]
        last[same + 1:] = [single.get(c, -1) for c in new]  # a single character: in the vocabulary, or spelled in bytes
        size[same + 1:] = [1] * len(new)
        before, settled = lead, same
        for at, (n, p) in matches(lead):
            end = at + 1
            if end <= settled:
                continue
            if n < end:
                a = last[end - n]
                ok = known.get(a << 32 | p)
                if not (e.admitted(a, p) if ok is None else ok):
                    continue
            last[end], size[end], settled = p, n, end
        found, end = [], len(lead)
        while end:
            p = last[end]
            if p < 0:
                found += [v.bytes_[b] for b in reversed(lead[end - 1].encode())]
            else:
                found.append(p)
            end -= size[end]
        found.reverse()
        if marks > 1 or marks == len(word):
            # Mark runs have the lowest score: they merge among themselves when all else is done.
            mark = single[MARK]
            alone = found[0] == mark
            spare = marks if alone else marks - 1
            run: list[int] = []
            for r in v.runs:
                run += [v.ids[r]] * (spare // len(r))
                spare %= len(r)
            found = run + [mark] * spare + found[alone:]
        out[word] = array(e.kind, found).tobytes()
    return out


def marked_words(text: str, v: Vocabulary) -> list[str]:
    """A marked text cut before every mark run and around line feeds."""
    return (_WORDS if "\n" not in v.ids else _SPACED).findall(text)


_WORDS = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n+")
_SPACED = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def units_of(text: str, v: Vocabulary) -> list[str]:
    """What a text's encoding is put together from: words without their mark, or, beginning with a mark or line feed, as they are.

    A plain word stands for itself behind one mark; one after a line feed keeps the line feed.
    """
    if MARK in text or "  " in text or text[0] in " \n" or text[-1] == " " or "\n " in text or " \n" in text or "\n" in v.ids:
        words = marked_words(MARK + text.replace(" ", MARK), v)
        return [w[1:] if w[0] == MARK and w[1:2] not in (MARK, "", "\n") else w if w[0] in (MARK, "\n") else "\n\n" + w for w in words]
    return text.replace("\n", " \n").split(" ")


def learn(units: list[str], e: Encoder) -> dict[str, bytes]:
    """Ids of units that the worker does not know."""
    after, plain = {}, []
    for u in units:
        if u[0] == "\n":
            after[u] = [u[2:]] if u[:2] == "\n\n" and u.strip("\n") else marked_words(u, e.v)
        else:
            plain.append(u if u[0] == MARK else MARK + u)
    found = encode_words(list({*plain, *chain.from_iterable(after.values())}), e)
    return {u: b"".join([found[w] for w in after[u]]) if u in after else found[u if u[0] == MARK else MARK + u] for u in units}


def encode_batch(texts: list[str | None], e: Encoder) -> pa.ListArray:
    """Ids of whole texts; null: null; empty: none."""
    cut = [units_of(t, e.v) if t else () for t in texts]
    young, older = e.words, e.older
    missing = [u for u in set().union(*cut) if u not in young]
    added = {u: older[u] for u in missing if u in older}
    added.update(learn([u for u in missing if u not in added], e))
    young.update(added)
    packed = [b"".join([young[u] for u in words]) for words in cut]
    # Two generations, each bounded in bytes: a full one becomes the older, from which words in use come back without a new pass.
    for u in added:
        if len(u) > LONGEST:
            del young[u]
    e.held += sum(210 + 2 * len(u) + len(added[u]) for u in added if len(u) <= LONGEST)
    if e.held > CACHE_BYTES:
        e.older, e.words, e.held = young, {}, 0
    width = array(e.kind).itemsize
    ends = np.cumsum([0, *[len(x) // width for x in packed]])
    values = np.frombuffer(b"".join(packed), f"u{width}").astype(np.int32)
    offsets = pa.array([None if t is None else int(b) for t, b in zip([*texts, ""], ends)], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values))


def decode_batch(ids: pa.ListArray, pieces: pa.Array) -> pa.Array:
    """Texts of lists of ids (``pieces``: the bytes of each id); null: null. Bytes that are no UTF-8 read back as replacement marks."""
    ids = pa.concat_arrays([ids])  # without an offset into a larger array
    starts = pc.list_value_length(ids).fill_null(0).to_numpy(zero_copy_only=False).cumsum()
    offsets = pa.array(np.concatenate([[0], starts]), pa.int32())
    joined = pc.binary_join(pa.ListArray.from_arrays(offsets, pieces.take(ids.flatten())), b"")
    try:
        texts = joined.cast(pa.string())
    except pa.ArrowInvalid:
        texts = pa.array([x.decode("utf-8", "replace") for x in joined.to_pylist()], pa.string())
    texts = pc.if_else(pc.starts_with(texts, " "), pc.utf8_slice_codeunits(texts, 1), texts)
    return pc.if_else(ids.is_null(), pa.scalar(None, pa.string()), texts)


_ready: WeakKeyDictionary[Any, Encoder] = WeakKeyDictionary()


def encoder_of(shared) -> Encoder:
    """The worker's encoder of a broadcast vocabulary; it lives across tasks of one worker, as long as the broadcast.

    A worker drops a broadcast with its first task that does not read it, so idle words do not weigh on later steps.
    """
    if shared not in _ready:
        _ready[shared] = Encoder(shared.value)
    return _ready[shared]


def _schema(rows: DataFrame, without: str = "") -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != without)


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """docs (id, text, ...) -> id, ids array<int>: whole texts; null text: null; empty text: no pieces; an empty table: no rows."""
    spark = docs.sparkSession
    small_arrow_batches(spark)
    shared = spark.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder_of(shared)
        for batch in batches:
            ids = encode_batch(batch.column("text").to_pylist(), e)
            names = batch.schema.names
            yield pa.record_batch([*[batch.column(n) for n in names if n != "text"], ids], names=[*[n for n in names if n != "text"], "ids"])

    return docs.mapInArrow(run, _schema(docs, "text") + "ids array<int>")


def decode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """rows (..., ids) -> the same columns and ``text``; null ids: null text. A mark in a text reads back as a space."""
    spark = rows.sparkSession
    small_arrow_batches(spark)
    shared = spark.sparkContext.broadcast(vocabulary.texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array([x or b"" for x in shared.value], pa.binary())
        for batch in batches:
            yield pa.record_batch([*batch.columns, decode_batch(batch.column("ids"), pieces)], names=[*batch.schema.names, "text"])

    return rows.mapInArrow(run, _schema(rows) + "text string")


def piece_report(docs: DataFrame, path: str = MODEL_PATH) -> DataFrame:
    """doc_id, n_pieces, ids, exact (decoding gives the text back) for every document, in one pass over the texts.

    Null text: all null but doc_id; empty text: no pieces; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    small_arrow_batches(spark)
    shared = spark.sparkContext.broadcast(read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder_of(shared)
        pieces = pa.array([x or b"" for x in e.v.texts], pa.binary())
        for batch in batches:
            text = batch.column(1)
            ids = encode_batch(text.to_pylist(), e)
            exact = pc.equal(decode_batch(ids, pieces), text.cast(pa.string()))
            yield pa.record_batch([batch.column(0), ids, exact], names=["doc_id", "ids", "exact"])

    rows = docs.select("doc_id", "text").mapInArrow(run, _schema(docs.select("doc_id")) + "ids array<int>, exact boolean")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "exact")
