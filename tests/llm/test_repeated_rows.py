"""Repeated and null ids, clashing names, and evidence of a language: cases that single out rows by their text."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickpulse.llm import langid, minhash, mixing
from tests.llm.test_llm import brute_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ("_nth", "ID", "_guess", "doc", "mark", "rep", "grp", "kept", "guess", "copies", "size", "key", "_doc_0")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS)


def near(text):
    return text.replace("seven", "eight")


A = "one two three four five six seven " + " ".join(f"a{i}" for i in range(60))
B = "red green blue yellow seven black " + " ".join(f"b{i}" for i in range(60))


def test_rows_that_share_an_id_are_judged_by_their_text(spark):
    """(1 A) (5 A) (5 B) (9 A') (9 B'): two groups, and one row of each stays."""
    rows = [(1, A), (5, A), (5, B), (9, near(A)), (9, near(B))]
    docs = frame(spark, rows).withColumns({c: F.lit(7) for c in ODD})
    kept = minhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted([(1, A), (5, B)]) and all(r["ID"] == 7 and r._nth == 7 for r in got)
    report = minhash.near_duplicate_report(frame(spark, rows), 5, 80).collect()
    assert sorted((r.doc_id, r.component_id) for r in report) == [(1, 1), (5, 1), (5, 5), (9, 1), (9, 5)]


def test_repeated_rows_and_blank_texts_of_one_id(spark):
    rows = [(3, A)] * 5 + [(3, None), (3, ""), (4, None), (None, A), (None, "lonely words without any id here"), (None, "")]
    got = minhash.one_of_each_group(frame(spark, rows)).collect()
    assert Counter(r.text for r in got if r.text) == {A: 1, "lonely words without any id here": 1}
    assert {r.doc_id for r in got if r.text == A} == {3} and {r.doc_id for r in got if not r.text} == {3, 4, None}


@pytest.mark.parametrize("block", [2, 256])
def test_members_that_miss_the_first_of_their_bucket(spark, block):
    """Texts around one body of shared words: chains of near copies whose ends are not alike, in many shared buckets."""
    rng = random.Random(block)
    body = [f"w{i}" for i in range(60)]
    texts = []
    for g in range(12):
        own = body[:]
        for step in range(9):
            for _ in range(2):
                own[rng.randrange(60)] = f"g{g}x{step}{rng.random():.3f}"
            texts.append(" ".join(own))
    ids = list(range(len(texts)))
    got = {r.id: r.component for r in minhash.near_duplicates(spark.createDataFrame(list(zip(ids, texts)), "id long, text string"), 3, 60, block=block).collect()}
    assert got == brute_components(ids, texts, 3, 60)


def test_mixing_nears_its_target_without_distinct_ids(spark):
    """One source of 1,000 words has the target 750 (half of it again, at most): rows without an id, of one id, of one text."""
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(10))
    for rows in ([(None, text(i)) for i in range(100)], [(4, text(i)) for i in range(100)], [(4, text(0))] * 100, [(None, text(0))] * 100, [(i, text(i)) for i in range(100)]):
        docs = frame(spark, rows).withColumns({c: F.lit(7) for c in ODD})
        source = frame(spark, [(1000 + i, text(i)) for i in range(200)]).withColumn("source", F.lit("b")).withColumns({c: F.lit(7) for c in ODD})
        both = docs.union(source)
        out = mixing.mix_report(both, labels).collect()
        for s, size in (("a", 1000), ("b", 2000)):
            mine = [r for r in out if r.source_size == size]
            assert abs(sum(r.taken for r in mine) - mine[0].target) <= 10 and max(r.taken for r in mine) <= 20, (s, rows[0])
        mixed = mixing.mix_documents(both, labels)
        assert mixed.columns == both.columns
        words = Counter(r.source for r in mixed.collect())
        assert {s: 10 * n for s, n in words.items()} == {s: sum(r.taken for r in out if r.source_size == size) for s, size in (("a", 1000), ("b", 2000))}


def test_language_query_is_und_only_without_letters(spark):
    """Scripts the model never saw and ties have a language in the query, but no evidence for the stage."""
    rows = [(i, "the cat sat on the mat", "en", "a", 1) for i in range(40)] + [(100 + i, "die katze sitzt auf der matte", "de", "a", 1) for i in range(40)]
    odd = [(1001, "გამარჯობა მსოფლიო", None, "a", 1), (1002, "привет мир", None, "a", 1), (1003, "我喜欢", None, "a", 1), (1004, "12 !?", None, "a", 1),
           (1005, None, None, "a", 1), (1006, "", None, "a", 1), (1007, "the die", None, "a", 1)]
    docs = spark.createDataFrame(rows + odd, DOCS).withColumns({c: F.lit(7) for c in ODD})
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.language_report(docs).collect()}
    for i in (1004, 1005, 1006):
        assert got[i] == ("und", 0.0)
    for i in (1001, 1002, 1003, 1007):
        assert got[i][0] in ("de", "en") and 0 < got[i][1] <= 1
    kept = langid.known_language(docs)
    assert kept.columns == docs.columns
    back = kept.collect()
    assert {r.doc_id for r in back}.isdisjoint(range(1001, 1007)) and {r.lang for r in back} == {"de", "en"} and {r._guess for r in back} == {7}


def test_language_scores_equal_brute_force(spark):
    """Posterior from the definition: gains of known words, longest known n-grams of others, scaled by the number of words."""
    import math

    import numpy as np

    rows = [(i, f"the cat sat on mat{i % 7} and ran", "en") for i in range(30)] + [(100 + i, f"die katze lief zu haus{i % 5} und sah", "de") for i in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df)
    units: dict = {}
    for _, text, lang in rows:
        for w in langid._WORD.findall(text.lower()):
            units.setdefault(("w", w), Counter())[lang] += 1
            for n in range(1, langid.ORDER + 1):
                for g in langid.grams_of(w, n):
                    units.setdefault((n, g), Counter())[lang] += 1
    mass = {k: {x: langid.LEAST_MASS + sum(c[x] for (kk, _), c in units.items() if kk == k) for x in ("de", "en")} for k in {k for k, _ in units}}
    gain = lambda k, u: np.array([math.log1p(units[k, u][x] * max(mass[k].values()) / mass[k][x] / langid.SMOOTH) for x in ("de", "en")])
    for text in ("the katze sat", "cats and kat", "haus3 mat", "zug", "und the mats liefen"):
        words = langid._WORD.findall(text.lower())
        total = np.zeros(2)
        for w in words:
            if ("w", w) in units:
                total += gain("w", w)
                continue
            for n in range(min(langid.ORDER, len(w) + 2), 0, -1):
                known = [g for g in langid.grams_of(w, n) if (n, g) in units]
                if known:
                    total += sum(gain(n, g) for g in known) / n
                    break
        lang, score, _ = langid.predict_text(text, model, {})
        best = int(total.argmax())
        assert lang == ("de", "en")[best]
        assert score == pytest.approx(1 / sum(math.exp((x - total[best]) / math.sqrt(len(words))) for x in total), rel=1e-6)
