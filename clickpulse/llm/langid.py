"""Language identification: word-first backoff to shorter and shorter character n-grams.

Words the model knows score by their log frequency per language, against a word it lacks. An unknown word is scored by its
longest known character n-grams (boundary marks included), falling back to shorter ones.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import small_arrow_batches, uniform

# The classifier is fitted on a sample of labelled documents and keeps every unit and every label of it.
SAMPLE_DOCS = 2000  # expected per language
ORDER = 5
SMOOTH = 0.5
LEAST_MASS = 1000  # added to each language's count, so that a few words do not weigh like a language
CACHE_BYTES = 28 << 20  # of unknown words that a worker remembers, by estimate
LONGEST = 64  # characters of a word that is remembered

_WORD = regex.compile(r"\p{L}+")


@dataclass
class Model:
    """langs in code point order; words and grams map a unit to its number.

    Unit i occurs in the languages ``where[starts[i]:starts[i + 1]]`` and adds ``gain`` of the same
    places to their scores; it adds nothing to the others.
    """

    langs: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    starts: np.ndarray
    where: np.ndarray
    gain: np.ndarray

    def total(self, units: list[int]) -> np.ndarray:
        """Sum of the gains of ``units`` per language."""
        at = np.array(units, np.int64)
        first, size = self.starts[at], self.starts[at + 1] - self.starts[at]
        ends = size.cumsum()
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)
        return np.bincount(self.where[places], self.gain[places], len(self.langs)).astype(float)  # without units: integers


def held_out(doc_id) -> F.Column:
    """crc32 of the id's text leaves 2 when divided by 4 (null id: false)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def grams_of(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)] if n > 1 else list(word)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: Counter = Counter()
        for lang, text in zip(*[c.to_pylist() for c in batch.columns]):
            seen.update((lang, w) for w in _WORD.findall(text.lower()))
        yield pa.record_batch([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()),
                               pa.array(list(seen.values()), pa.int64())], names=["lang", "unit", "n"])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: Counter = Counter()
        for lang, word, n in zip(*[c.to_pylist() for c in batch.columns]):
            for size in range(1, ORDER + 1):
                for g in grams_of(word, size):
                    seen[lang, g] += n
        yield pa.record_batch([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()),
                               pa.array(list(seen.values()), pa.int64())], names=["lang", "unit", "n"])


def _numbered(counts: pa.Table, langs: list[str], by_size: bool) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """counts (lang, unit, n) -> units, and their starts, where and gain as in Model.

    A gain is log((n + SMOOTH) / SMOOTH), with n scaled as if each language had as many units (of one
    length, if ``by_size``) as the largest one: a unit that a language lacks then counts the same for all.
    """
    coded = counts.column("unit").combine_chunks().dictionary_encode()
    units, unit = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
    lang = pc.index_in(counts.column("lang").combine_chunks(), pa.array(langs, pa.string())).to_numpy().astype(np.int32)
    n = counts.column("n").to_numpy().astype(float)
    kind = (np.array([len(u) for u in units], np.int64) if by_size else np.zeros(len(units), np.int64))[unit]
    mass = np.bincount(kind * len(langs) + lang, n, (ORDER + 1) * len(langs)).reshape(ORDER + 1, len(langs)) + LEAST_MASS
    gain = np.log1p(n * (mass.max(axis=1, keepdims=True) / mass)[kind, lang] / SMOOTH)
    order = np.argsort(unit, kind="stable")
    return units, np.concatenate([[0], np.bincount(unit, minlength=len(units)).cumsum()]), lang[order], gain[order]


def train(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """labelled (doc_id, text, lang), null-free -> Model.

    Each language gives about ``sample_docs`` documents, chosen by a hash of the id (all, if it has
    fewer). The model holds every label, word and n-gram of the sample, so it grows with the number
    of languages, not with the corpus.
    """
    small_arrow_batches(labelled.sparkSession)
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("n")).toArrow()
    langs = sorted(sizes.column("lang").to_pylist())
    if not langs:
        return Model([], {}, {}, np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0))
    rates = labelled.sparkSession.createDataFrame(sizes).select(F.col("lang").alias("_lang"), (F.lit(float(sample_docs)) / F.col("n")).alias("rate"))
    sample = labelled.join(F.broadcast(rates), F.col("lang") == F.col("_lang")).where(uniform(5, F.col("doc_id")) < F.col("rate"))
    unit = "lang string, unit string, n long"
    words = sample.select("lang", "text").mapInArrow(_count_words, unit).groupBy("lang", "unit").agg(F.sum("n").alias("n")).persist()
    word, word_starts, *word_rows = _numbered(words.toArrow(), langs, False)
    grams = words.mapInArrow(_count_grams, unit).groupBy("lang", "unit").agg(F.sum("n").alias("n"))
    gram, gram_starts, *gram_rows = _numbered(grams.toArrow(), langs, True)
    words.unpersist()
    return Model(langs, {u: i for i, u in enumerate(word)}, {u: i for i, u in enumerate(gram, len(word))},
                 np.concatenate([word_starts, gram_starts[1:] + word_starts[-1]]), *map(np.concatenate, zip(word_rows, gram_rows)))


def unseen(word: str, model: Model) -> np.ndarray:
    """Log score per language of a word the model does not know."""
    for n in range(min(ORDER, len(word) + 2), 0, -1):
        known = [model.grams[g] for g in grams_of(word, n) if g in model.grams]
        if known:
            return model.total(known) / n
    return np.zeros(len(model.langs))


def predict_text(text: str | None, model: Model, cache: dict[str, np.ndarray]) -> tuple[str, float, bool]:
    """(language, posterior, evidence), or ('und', 0.0, False) for null, a text without letters, or a model without languages.

    Ties go to the first language in code point order. There is evidence if one language alone has the
    best score, above zero, and at least half of the letters stand in words with a known word or n-gram.
    """
    words = _WORD.findall(text.lower()) if text else []
    if not words or not model.langs:
        return "und", 0.0, False
    at, rest = [], []
    find = model.words.get
    for w in words:
        i = find(w)
        (rest.append(w) if i is None else at.append(i))
    total, blind = model.total(at), 0
    for w in rest:
        v = cache.get(w)
        if v is None:
            v = unseen(w, model)
            if len(w) <= LONGEST:
                if len(cache) >= CACHE_BYTES // (260 + 8 * len(model.langs)):
                    cache.clear()
                cache[w] = v
        total += v
        if not v.any():
            blind += len(w)
    best = int(total.argmax())
    sure = 2 * blind <= sum(map(len, words)) and (total == total[best]).sum() == 1 and total[best] > 0
    return model.langs[best], float(1 / np.exp((total - total[best]) / math.sqrt(len(words))).sum()), bool(sure)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """docs (doc_id, text) -> doc_id, held_out, lang_pred, score, over whole texts."""
    spark = docs.sparkSession
    small_arrow_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, np.ndarray] = {}
        known = shared.value
        for batch in batches:
            found = [predict_text(t.as_py(), known, cache) for t in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([x[0] for x in found], pa.string()),
                                   pa.array([x[1] for x in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")


def labelled_rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", "lang").where("doc_id is not null and text is not null and lang is not null").where(~held_out(F.col("doc_id")))


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``documents``; learns from labelled rows that are not held out.

    ``und`` with score 0 stands for a null text, one without letters, and, if no row can train a model,
    for all; every other text has the best language, however weak. Repeated rows come back as often as
    they are given; an empty table gives no rows; other columns are not read.
    """
    return predict(docs.select("doc_id", "text"), train(labelled_rows(docs)))


def known_language(docs: DataFrame, least: float = 0.0) -> DataFrame:
    """The rows of ``docs`` whose whole text has a language (score ``least`` or more); a null lang takes the predicted one.

    A text has a language if predict_text finds evidence for one, labelled or not: texts in a script the
    model never saw, and ties, go. If no row can train a model, it has one if it has letters, and lang
    stays as it is. Other columns, whatever their names, and repeated rows stay as they are; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    model = train(labelled_rows(docs))
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    small_arrow_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, sure boolean")
    def guess(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache: dict[str, np.ndarray] = {}
        known = shared.value
        for batch in texts:
            yield pd.DataFrame([predict_text(t, known, cache) for t in batch], columns=["lang", "score", "sure"])

    # One struct holds the given columns, so no name of theirs can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), guess(F.col("text")).alias("guess"))
    rows = rows.where(F.col("guess.sure") & (F.col("guess.score") >= least))
    return rows.select(*[F.coalesce("doc.lang", "guess.lang").alias(c) if c.lower() == "lang" else F.col(f"doc.`{c}`") for c in docs.columns])
