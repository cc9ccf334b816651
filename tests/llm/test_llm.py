"""Training-data operators against SQL twins, brute force, public libraries and messy small tables."""

from __future__ import annotations

import gc
import hashlib
import math
import os
import pathlib
import random
import re
import weakref
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickpulse.llm import crossentropy, langid, lzprint, minhash, mixing, pieces, pivots, queries, quotes, tokencounts, urlfilter
from clickpulse.llm.components import connected_components
from clickpulse.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


@pytest.fixture(scope="module")
def messy(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties, clashing names."""
    long_text = "alpha beta gamma delta " * 30_000
    data = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 1), (1, "the quick brown fox jumps over the lazy dog", "en", "a", 1),
        (2, "the quick brown fox jumps over the lazy dog", "en", "b", 1), (3, None, None, None, None), (4, "", "en", "a", 0),
        (5, " \t\n", "en", None, 3), (None, "der schnelle braune fuchs springt", "de", "b", 2), (None, None, None, None, None),
        (6, long_text, "en", "a", 5), (7, "...!!! 123", None, "b", 1), (8, "x" * 5000, "en", "c", 1), (9, "zwei wörter", "de", "c", 1),
    ]
    df = spark.createDataFrame(data, DOCS)
    return df.withColumns({c: F.lit(7) for c in ("id", "size", "key", "target", "copies", "block", "slice", "ids", "grp", "u", "v")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, k):
    w = words((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_components(ids, texts, k, percent):
    sets = [shingles(t, k) for t in texts]
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(ids[i]), root(ids[j])))
                up[b] = a
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    cols = sorted(want.columns)
    got = queries.queries()[name](spark, SF).select(*cols).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.select(*[duckdb.ColumnExpression(c) for c in cols]).fetchall()))


def test_mixing_bounds_and_reruns(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    a = mixing.mix_report(docs, labels).collect()
    assert sorted(a) == sorted(mixing.mix_report(docs.repartition(7), labels).collect())
    assert all(r.taken in (0, r.size, 2 * r.size) for r in a)
    assert sum({r.source_size: r.target for r in a}.values()) <= 1.5 * sum(r.size for r in a) + 1e-6
    copies = Counter(r.doc_id for r in mixing.mix_documents(docs, labels).collect())
    assert all(copies[r.doc_id] * r.size == r.taken for r in a)


def test_mixing_messy(spark, messy, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    got = mixing.mix_report(messy, labels).collect()
    assert len(got) == messy.count() and all(r.taken <= 2 * r.size for r in got)
    assert mixing.mix_documents(messy, labels).columns == messy.columns
    assert mixing.mix_report(empty, labels).count() == 0


def test_top_k_ties_and_bad_vectors(spark):
    same = [1.0, 2.0]
    data = [(0, same), (100, same), (3, same), (2, same), (2, same), (4, [9.0]), (5, None), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 0.0]), (None, same), (9, [])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in pivots.search_report(df, k=4).orderBy("query_id", "rank").collect()]
    s, t = 1024 * 1024 * 5, 1024 * 1024 * 9
    assert got == [(0, 1, 4, t), (0, 2, 2, s), (0, 3, 3, s), (0, 4, 100, s), (100, 1, 4, t), (100, 2, 0, s), (100, 3, 2, s), (100, 4, 3, s)]
    assert pivots.search_report(df.where("vec_id = 5")).count() == 0


def test_top_k_small_rings(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(-50, 50, (400, 8))
    x[:150] = x[0]
    vectors = spark.createDataFrame([(i, [int(a) for a in v]) for i, v in enumerate(x)], "vec_id long, v array<long>")
    asked = vectors.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    got = {}
    for r in pivots.top_k(vectors, asked, k=5, pivots=6, sample=64, ring=16).collect():
        got[r.query_id, r.rank] = (r.vec_id, r.score)
    for q in range(0, 400, 20):
        best = sorted((-int(x[q] @ x[i]), i) for i in range(400) if i != q)[:5]
        assert [got[q, n + 1] for n in range(5)] == [(i, -s) for s, i in best]


def test_url_filter_edges(spark):
    data = [(1, "HTTP://A.Example.ORG/es/1"), (2, "x://example.org"), (3, "x://org/"), (4, "no host"), (5, None), (None, "x://spam-a.net/?q"), (6, "x://m.spam-a.net#x"),
            (7, "x://notexample.org/es/"), (8, "x://com?/de/"), (8, "x://a.com/de/x?y"), (9, "x://é.com/fr/")]
    got = [tuple(r)[1:] for r in urlfilter.url_report(spark.createDataFrame(data, "page_id long, url string").withColumn("host", F.lit(1))).collect()]
    assert got == [
        ("a.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "", None, "allow"), ("org", "/", "org/", "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("spam-a.net", "/", None, "block"), ("m.spam-a.net", "", None, "block"), ("notexample.org", "/es/", "org/", "allow"), ("com", "", None, "allow"),
        ("a.com", "/de/x", "com/de/", "block"), ("é.com", "/fr/", "com/fr/", "allow")]
    assert urlfilter.url_report(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_cascade_is_exact(spark):
    keys = spark.range(4000).select(F.xxhash64("id").alias("h1"), F.xxhash64(F.lit(1), "id").alias("h2"), (F.col("id") % 11 == 0).alias("hit"))
    levels = urlfilter.cascade(keys, "hit")
    got = keys.toPandas()
    assert len(levels) > 1
    assert (urlfilter.member(got.h1.to_numpy(), got.h2.to_numpy(), levels) == got.hit.to_numpy()).all()


def test_quotation_links(spark):
    data = [
        (1, 0, "user", "Hello there\n\nHow do I   build it?"), (1, 1, "assistant", "Use make.\nThen install."),
        (1, 2, "user", "On Monday Bot wrote:\n> use MAKE.\nIt fails"), (1, 3, "user", "> > use make.\n> It fails\nMe too"),
        (1, 4, "assistant", "> How do I build it?\n> unknown line\nLike this"), (1, 5, "user", "> never said\nhm"), (2, 0, "user", None), (None, 1, "user", "> Use make.\nx"), (2, None, None, "> ")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumn("level", F.lit(0))
    got = {(r.conv_id, r.turn): (r.position, r.reply_to, r.thread, r.n_quotes, r.n_linked, r.text) for r in quotes.reply_ordered(df).collect()}
    assert got == {
        (1, 0): (1, None, 0, 0, 0, "Hello there\n\nHow do I   build it?"), (1, 4): (2, 0, 0, 1, 1, "Like this"),
        (1, 1): (3, None, 1, 0, 0, "Use make.\nThen install."), (1, 2): (4, 1, 1, 1, 1, "It fails"), (1, 3): (5, 2, 1, 2, 2, "Me too"),
        (1, 5): (6, None, 5, 1, 0, "hm"), (2, 0): (1, None, 0, 0, 0, ""), (2, None): (2, None, None, 1, 0, ""), (None, 1): (1, None, 1, 1, 0, "x")}
    assert quotes.reply_ordered(df.limit(0)).count() == 0


def test_quotes_of_sentences(spark):
    """The middle sentence of a one-line message, and part of a paragraph with other line breaks, are found; the longest match wins."""
    data = [(1, 0, "a", "We met in May. The bridge was closed for repairs! Nobody knew why."), (1, 1, "b", "Short one. The river rose\nby two metres in a night. All boats\nwere lost."),
            (1, 2, "c", "> The bridge was closed for repairs!\nReally?"), (1, 3, "d", "> The river rose by two\n> metres in a night. All\n> boats were lost.\nSad."),
            (1, 4, "e", "> nobody knew why. The river rose by two metres in a night.\nBoth."), (1, 5, "f", "> bridge was closed\nNo sentence.")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = {r.turn: (r.reply_to, r.n_linked) for r in quotes.reply_ordered(df).collect()}
    assert got == {0: (None, 0), 1: (None, 0), 2: (0, 1), 3: (1, 1), 4: (1, 1), 5: (None, 0)}


def test_products_beyond_64_bits_are_an_error(spark):
    rows = [(i, [1e13 + i, 1e13]) for i in range(3)]
    with pytest.raises(ValueError, match="64-bit"):
        pivots.search_report(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).count()


def test_level_bound_is_an_argument(spark):
    pages = spark.createDataFrame([(i, f"http://h{i}.casino.net/x") for i in range(50)], "page_id long, url string")
    with pytest.raises(ValueError, match="max_megabytes"):
        urlfilter.url_report(pages, max_megabytes=0).count()
    listed = spark.createDataFrame([("h1.casino.net",)], "key string")
    got = {r.page_id: r.verdict for r in urlfilter.url_report(pages, listed).collect()}
    assert [i for i, v in got.items() if v == "block"] == [1]


def test_language_held_out_accuracy(docs, rows, messy, empty):
    got = {r.doc_id: r for r in langid.language_report(docs).collect()}
    held = [r for r in rows if got[r.doc_id].held_out and r.text]
    assert len(got) == len(rows) and held
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.95 * len(held)
    odd = [(r.lang_pred, r.score) for r in langid.predict(messy.where("doc_id in (3, 4, 5, 7)").select("doc_id", "text"), langid.train(langid.labelled_rows(docs))).collect()]
    assert odd == [("und", 0.0)] * 4
    assert langid.language_report(messy).count() == messy.count() and langid.language_report(empty).count() == 0
    kept = langid.known_language(messy)
    assert kept.columns == messy.columns and {r.text for r in kept.collect()}.isdisjoint({None, "", " \t\n", "...!!! 123"})


def test_language_backs_off(docs):
    model = langid.train(langid.labelled_rows(docs))
    word = next(w for w in model.words if len(w) > 7) + "x"
    assert word not in model.words and np.abs(langid.unseen(word, model)).sum() > 0
    assert np.abs(langid.unseen("語", model)).sum() == 0


def test_language_keeps_rare_languages(spark):
    """Three texts of one language beside 140,000 words of another, and more labels than 1,000."""
    big = [(i, " ".join(f"w{i:03d}{j:03d}".translate(str.maketrans("0123456789", "abcdefghij")) for j in range(700)), "en") for i in range(200)]
    rare = [(1000 + i, t, "ka") for i, t in enumerate(["თბილისი დიდი ქალაქია", "მდინარე მიედინება ნელა", "წიგნი მაგიდაზე დევს"])]
    few = [(2000 + i, chr(0x4E00 + i) * 2, f"x{i:04d}") for i in range(1100)]
    model = langid.train(spark.createDataFrame(big + rare + few, "doc_id long, text string, lang string"))
    assert len(model.langs) == 1102 and len(model.words) > 140_000
    for _, text, lang in (*big[::40], *rare, *few[::100], (0, "ქალაქია მდინარე", "ka"), (0, "ქალაქში", "ka"), (0, "waaabbb", "en")):
        assert langid.predict_text(text, model, {})[0] == lang


def test_language_stage_needs_evidence(spark, docs):
    """Planted rows in a script that the model never saw go, mixed ones by their letters; short clean ones stay."""
    text = docs.where("lang is not null and text is not null").orderBy("doc_id").first().text
    word = max(re.findall(r"[^\W\d_]+", text), key=len)
    planted = [(10**6 + i, t, lang) for i, (t, lang) in enumerate([
        ("გამარჯობა მსოფლიო", None), ("გამარჯობა მსოფლიო", "en"), (f"გამარჯობა მსოფლიო როგორ ხარ დღეს {word[:4]}", None), ("我喜欢这个很长的句子 a", None),
        (word, None), (f"{word}x", None), (f"{text} გამარჯობა", None)])]
    own = docs.where("lang is null or lang <> 'ka'").select("doc_id", "text", "lang")
    rows = spark.createDataFrame([(i, t, lang) for i, t, lang in planted if lang is None], own.schema)
    held = spark.createDataFrame([(i, t, lang) for i, t, lang in planted if lang is not None], own.schema)
    held = held.withColumn("doc_id", F.lit(next(i for i in range(10**6, 10**6 + 99) if spark.range(1).where(langid.held_out(F.lit(i).cast("long"))).count())))
    got = {r.text: r.lang for r in langid.known_language(own.union(rows).union(held)).collect()}
    gone = {t for _, t, _ in planted[:4]}
    assert gone.isdisjoint(got) and all(got[t] for _, t, _ in planted[4:])
    # Without any label the stage keeps what has letters.
    bare = own.withColumn("lang", F.lit(None).cast("string")).union(rows)
    kept = langid.known_language(bare).collect()
    assert {t for _, t, lang in planted if lang is None} <= {r.text for r in kept} and all(r.lang is None and re.search(r"[^\W\d_]", r.text) for r in kept)


def test_token_counts(spark, rows, messy, empty):
    import tiktoken

    enc = tiktoken.Encoding("t", pat_str=tokencounts.PATTERN, mergeable_ranks=tokencounts.read_ranks(), special_tokens={})
    lengths = tokencounts.Lengths(enc.encode_ordinary)
    odd = ["a  b", " a", "a ", "  ", "a \n b", "a\u00a0 b c", "it's 's 'll", "x" * 3000, "1 22\t3", "\n\n a b", ". . ."]
    for t in [*odd, *(r.text for r in rows)]:
        assert tokencounts.token_count(t, lengths) == len(enc.encode_ordinary(t or ""))
    n = [len(enc.encode_ordinary(r.text or "")) for r in rows]
    limits = spark.createDataFrame([(100,), (512,)], "n_tokens int")
    hist = tokencounts.length_histogram(tokencounts.token_lengths(spark.createDataFrame(rows, DOCS)))
    answers = tokencounts.limit_answers(hist, limits)
    for r in answers.collect():
        c = r.n_tokens
        assert r.kept_tokens == sum(min(x, c) for x in n) and r.longer == sum(x > c for x in n) and r.documents == n.count(c)
        assert r.lost_tokens == sum(n) - r.kept_tokens and r.tokens == sum(x for x in n if x <= c)
    assert tokencounts.quantile(answers, 0.5).first()[0] == sorted(n)[math.ceil(len(n) / 2) - 1]
    assert tokencounts.token_report(messy).agg(F.sum("documents")).first()[0] == messy.count()
    assert tokencounts.token_report(empty).count() == 0


def test_pieces_equal_the_library(docs, rows, messy, empty):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    got = pieces.piece_report(docs).collect()
    text = {r.doc_id: r.text for r in rows}
    assert len(got) == len(rows) and all(r.exact and r.ids == sp.encode(text[r.doc_id]) for r in got if text[r.doc_id] is not None)
    v = pieces.Encoder(pieces.read_vocabulary())
    odd = ["", " ", "   a", "a" + " " * 37 + "b", "漢字 🙂", "\n \n", "é" * 200, None]
    assert pieces.encode_batch(odd, v).to_pylist() == [None if t is None else sp.encode(t) for t in odd]
    small = pieces.Encoder(pieces.read_vocabulary())
    with pytest.MonkeyPatch.context() as patch:  # generations turn over many times
        patch.setattr(pieces, "CACHE_BYTES", 10_000)
        for r in rows[:60]:
            assert pieces.encode_batch([r.text, r.text], small).to_pylist() == [None if r.text is None else sp.encode(r.text)] * 2
    assert small.older
    rng = random.Random(1)
    mixed = ["".join(rng.choices(["a", "the", "\n", " ", "  ", "▁", "é", "\t", "ing", "漢", "🙂", "\n\n", "\x00"], k=rng.randint(1, 25))) for _ in range(700)]
    mixed += ["▁a", "a ▁ b", " x", "x ", "a\nb", "a\n\nb", "\na", "a\n", "a \nb", "a\n b", "\n\nab", "a\n\nab cd\nab", "<0x0A>", "<s> </s>", "\x00a b"]
    spelled = pa.array([x or b"" for x in v.v.texts], pa.binary())
    for i in range(0, len(mixed), 7):
        ids = pieces.encode_batch(mixed[i:i + 7], v)
        assert ids.to_pylist() == [sp.encode(t) for t in mixed[i:i + 7]]
        assert pieces.decode_batch(ids, spelled).to_pylist() == [t.replace("▁", " ") for t in mixed[i:i + 7]]
    again = pieces.decode(pieces.encode(docs.select("doc_id", "text"), v.v), v.v)
    assert {r.doc_id: r.text for r in again.collect()} == text
    out = pieces.piece_report(messy).collect()
    assert len(out) == messy.count() and all(r.exact in (True, None) for r in out)
    assert pieces.piece_report(empty).count() == 0


def brute_fingerprint(data):
    order = sorted(data, key=lambda r: r[0], reverse=True)
    out = {}
    for i, (doc_id, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1] or ""
        text = text or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        a, b, c = (lzprint.fingerprint(t) for t in (text, edited, following))
        out[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), lzprint.as_text(a), lzprint.as_text(b), lzprint.likeness(a, b), lzprint.likeness(a, c))
    return out


def test_fingerprints(spark, docs, rows, messy, empty):
    got = {r[0]: tuple(r)[1:] for r in lzprint.fingerprint_report(docs.repartition(3)).collect()}
    assert got == brute_fingerprint([(r.doc_id, r.text) for r in rows])
    one = spark.createDataFrame([(5, "abc abc abc")], "doc_id long, text string")
    assert lzprint.fingerprint_report(one).first().near_next == 1.0
    assert lzprint.fingerprint_report(messy).count() == messy.count()
    assert lzprint.fingerprint_report(empty).count() == 0


def test_phrase_parse():
    p = lzprint.Parse()
    p.feed("aababcabc")
    assert p.phrases == {"a", "ab", "abc"} and p.open == "abc"


def test_cross_entropy(spark, rows, messy, empty):
    data = [(r.doc_id, r.text) for r in rows[:40]]
    wanted = {i for i, _ in data[::3]}
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: r for r in crossentropy.cross_entropy_difference(df, spark.createDataFrame([(i,) for i in wanted], "doc_id long")).collect()}
    total = {True: sum(len(t) for i, t in data if i in wanted), False: sum(len(t) for i, t in data if i not in wanted)}
    rate = min(1.0, total[True] / total[False])
    others = {i for i, _ in data} - wanted

    def grams(t):
        s = "\0\0" + t
        return [s[i:i + 3] for i in range(len(t))]

    vocab = {c for _, t in data for c in t}

    def model(ids, scale):
        c3 = {g: n * scale for g, n in Counter(g for i, t in data if i in ids for g in grams(t)).items()}
        c2, c1, x2, x1 = Counter(), Counter(), Counter(), Counter()
        for g, n in c3.items():
            c2[g[1:]] += n
            c1[g[2]] += n
            x2[g[:2]] += n
            x1[g[1]] += n
        k, n = crossentropy.PRIOR, sum(c1.values())

        def loss(g):
            p = (c1[g[2]] + 1) / (n + len(vocab) + 1)
            p = (c2[g[1:]] + k * p) / (x1[g[1]] + k)
            return -math.log2((c3.get(g, 0) + k * p) / (x2[g[:2]] + k))

        return loss

    t, b = model(wanted, 1.0), model(others, rate)
    for i, text in data:
        g = grams(text)
        assert got[i].n_tokens == len(text)
        assert got[i].score == pytest.approx((sum(map(t, g)) - sum(map(b, g))) / len(g), abs=1e-9)
    labels = spark.createDataFrame([(1, 1), (None, 1)], "doc_id long, quality int")
    out = crossentropy.lm_report(messy, labels).collect()
    assert len(out) == messy.count() and all((r.score is None) == (r.n_tokens == 0) for r in out)
    assert crossentropy.lm_report(empty, labels).count() == 0


def test_documents_like_the_target_score_lower(spark, docs, monkeypatch):
    """Labels on half of one language's documents: the other half scores below all documents of other languages; many small blocks, one hot id."""
    monkeypatch.setattr(crossentropy, "BLOCK_CHARS", 5_000)
    data = [(r.doc_id, r.text, r.lang) for r in docs.where("lang in ('fr', 'en', 'de') and length(text) > 300").orderBy("doc_id").limit(90).collect()]
    mine = [i for i, _, lang in data if lang == "fr"]
    labels = spark.createDataFrame([(i, 1) for i in mine[::2]], "doc_id long, quality int")
    hot = [(-7, t) for _, t, lang in data if lang == "en"]
    got = crossentropy.lm_report(spark.createDataFrame([(i, t) for i, t, _ in data] + hot, "doc_id long, text string"), labels).collect()
    assert len(got) == len(data) + len(hot)
    score = {r.doc_id: r.score for r in got}
    assert max(score[i] for i in mine[1::2]) < min([score[i] for i, _, lang in data if lang != "fr"] + [r.score for r in got if r.doc_id == -7])


def test_cross_entropy_counts_the_whole_background(spark, rows):
    """Labels that stay few: the background is all other documents, rows without id too, at the target's mass."""
    data = [(None if n % 5 == 4 else r.doc_id, r.text) for n, r in enumerate(rows[:40])]
    wanted = {i for i, _ in data[:4]}
    labels = spark.createDataFrame([(i, 1) for i in wanted], "doc_id long, quality int")
    got = {(r.doc_id, r.n_tokens): r for r in crossentropy.lm_report(spark.createDataFrame(data, "doc_id long, text string"), labels).collect()}
    other = [t for i, t in data if i not in wanted]
    scale = min(1.0, sum(len(t) for i, t in data if i in wanted) / sum(map(len, other)))
    assert scale < 0.5
    vocab = {c for _, t in data for c in t}
    c1, c2, c3, x1, x2 = (Counter() for _ in range(5))
    for t in other:
        s = "\0\0" + t
        for j in range(len(t)):
            for c, g in ((c3, s[j:j + 3]), (c2, s[j + 1:j + 3]), (c1, s[j + 2]), (x2, s[j:j + 2]), (x1, s[j + 1])):
                c[g] += scale
    k, n = crossentropy.PRIOR, sum(c1.values())

    def loss(g):
        p = (c1[g[2]] + 1) / (n + len(vocab) + 1)
        p = (c2[g[1:]] + k * p) / (x1[g[1]] + k)
        return -math.log2((c3[g] + k * p) / (x2[g[:2]] + k))

    for i, t in data:
        s = "\0\0" + t
        r = got[i, len(t)]
        assert r.background_loss == pytest.approx(sum(loss(s[j:j + 3]) for j in range(len(t))) / len(t), abs=1e-9)
        assert r.score == pytest.approx(r.target_loss - r.background_loss, abs=1e-9)


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (7, 7), (None, 3), (200, 201), (201, 200)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(chain, "u long, v long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_in_blocks(spark):
    """A group whose members do not all match its first one; blocks of three rows."""
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(40):  # each text differs from the one before in one word, so links form a chain
        base[i * 2] = f"changed{i}"
        texts.append(" ".join(base))
    texts += ["one two", "one two", "one", "", None, " ".join(base) + " tail"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: r.component for r in minhash.near_duplicates(df, 3, 85, block=3).collect()}
    assert got == brute_components(list(range(len(texts))), texts, 3, 85)


def test_encoder_goes_with_its_broadcast():
    """Words that a worker remembers do not outlive the broadcast vocabulary."""

    class Shared:
        value = pieces.read_vocabulary(pieces.MODEL_PATH)

    shared = Shared()
    e = pieces.encoder_of(shared)
    assert pieces.encode_batch(["some words", None], e).to_pylist()[1] is None
    assert pieces.encoder_of(shared) is e
    gone = weakref.ref(e)
    del e, shared
    gc.collect()
    assert gone() is None


def test_narrow_tables_are_few_files(spark):
    """Hadoop launches processes for each file that a task writes: small tables are one file, however many partitions."""
    scratch = pathlib.Path(re.sub("^file:/*", "/", ensure_checkpoint_dir(spark))) / "clickpulse"
    before = set(scratch.glob("*"))
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[:i] + [f"x{k}"] + words[i:]) for k in range(40) for i in (30, 31 + k % 3)]
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
        got = {r.id: r.component for r in minhash.near_duplicates(df, 3, 85).collect()}
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert got == brute_components(list(range(len(texts))), texts, 3, 85)
    files = {}
    for d in set(scratch.glob("*")) - before:
        name = d.name.rsplit("-", 1)[0]
        files[name] = max(files.get(name, 0), len(list(d.glob("part-*"))))
    narrow = {"buckets", "members", "star-pairs", "star", "star-links", "star-components", "placed", "open", "links", "least", "group-of-set"}
    assert {k: v for k, v in files.items() if k in narrow} == dict.fromkeys(narrow, 1)


def test_near_duplicates_messy(spark, messy, empty):
    got = minhash.near_duplicate_report(messy).collect()
    assert len(got) == messy.count()
    assert {(r.component_id, r.kept) for r in got if r.doc_id == 2} == {(1, False)}
    assert all(r.kept for r in got if r.doc_id != 2)
    one = minhash.one_of_each_group(messy)
    assert one.columns == messy.columns
    assert sorted(r.doc_id for r in one.collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 7, 8, 9]
    assert minhash.near_duplicate_report(empty).count() == 0


def test_pipeline_against_brute_force(spark, docs, rows):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    with_letters = [r for r in rows if r.text and re.search(r"[^\W\d_]", r.text)]
    comp = brute_components([r.doc_id for r in with_letters], [r.text for r in with_letters], 5, 80)
    left = docs
    for _, stage in corpus_pipeline.STAGES[:2]:
        left = stage(spark, left, SF)
        assert left.columns == docs.columns
    kept = {r.doc_id for r in with_letters if comp[r.doc_id] == r.doc_id}
    assert {r.doc_id for r in left.collect()} == kept
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    want = Counter(r.doc_id for r in mixing.mix_documents(docs.where(F.col("doc_id").isin(sorted(kept))), labels).collect())
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in got) == want
    text = {r.doc_id: r.text for r in rows}
    assert all(r.ids == sp.encode(text[r.doc_id]) and r.n_pieces == len(r.ids) for r in got)


def test_nothing_else_imports_this_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(os.path.join(root, "clickpulse")):
        if os.path.basename(folder) != "llm":
            for n in names:
                if n.endswith(".py"):
                    with open(os.path.join(folder, n), encoding="utf-8") as f:
                        assert "clickpulse.llm" not in f.read(), n
