"""Cross-tokenizer alignment against whole-text brute force and messy small tables."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from clickpulse.llm import alignment, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows):
    """Whole texts through both libraries, offsets by running sums; no units, no deduplication."""
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(alignment.BYTE_PATH)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_PATH)
    alphabet = alignment.byte_alphabet()
    own = {i: bytes(alphabet[c] for c in t) for t, i in one.get_vocab(with_added_tokens=False).items()}
    out, holders = [], Counter()
    for doc_id, text in rows:
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        ta = [own[i] for i in a]
        tb = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(ta) != (" " + text).encode() or b"".join(tb) != (" " + text).encode():
            out.append((doc_id, [], [], [], Counter()))
            continue
        ends = lambda ts: [sum(map(len, ts[:0]))] if not ts else __import__("itertools").accumulate(map(len, ts))
        ea, eb = list(ends(ta)), list(ends(tb))
        shared = sorted(set(ea) & set(eb))
        group = {e: k for k, e in enumerate(shared)}
        ga, gb, k = defaultdict(list), defaultdict(list), 0
        for ids, offs, g in ((a, ea, ga), (b, eb, gb)):
            k = 0
            for i, e in zip(ids, offs):
                g[k].append(i)
                k += e in group
        links = Counter((p, q) for k in range(len(shared)) for p in ga[k] for q in gb[k])
        out.append((doc_id, a, b, [(ga[k], gb[k]) for k in range(len(shared))], links))
        holders.update(links.keys())
    most: dict = {}
    for (p, _), n in holders.items():
        most[p] = max(n, most.get(p, 0))
    return [(d, len(a), len(b), len(g), sum(links.values()), sum(n for (p, q), n in links.items() if holders[p, q] == most[p]),
             sum(n * holders[x] for x, n in links.items()),
             hashlib.sha256(";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in g).encode()).hexdigest() if g else "")
            for d, a, b, g, links in out]


def compare(df, rows):
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(brute(rows), key=repr)


def test_query_equals_brute_force(spark):
    compare(queries.op13_alignment(spark, SF), [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()])


def odd_texts():
    rng = random.Random(5)
    alphabet = ["a", "B", "the", " ", " ", "  ", "\n", "\n\n", "\t", "é", "語", "😀", " ", " ", "'s", "12", "...", "\x1c", "\x85", "<|endoftext|>", "‍", "\r", "<s>", "ing", "<0x0A>"]
    return ["".join(rng.choices(alphabet, k=rng.randint(1, 30))) for _ in range(400)]


def test_odd_texts(spark):
    """White space of all kinds, special strings, marks, control characters, long unspaced and very long texts."""
    texts = [*odd_texts(), "▁", "a ▁b", " lead", "trail ", "\nfirst line", "a\nb", "x" * 5000, "ab" * 3000, "語" * 2000, "́" * 300, "\x00", "a\x00b c",
             "alpha beta gamma delta\n" * 20_000, " ", "\n", "﻿mark", "ﬁ ligature Å", "a b"]
    rows = [(i, t) for i, t in enumerate(texts)]
    compare(alignment.alignment_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)), rows)


def test_messy_rows(spark):
    rows = [(1, "the same text"), (1, "the same text"), (2, "the same text"), (1, "another text"), (None, "the same text"), (None, None), (3, None), (4, ""), (5, "the")]
    df = spark.createDataFrame([(a, b, None, None, None) for a, b in rows], DOCS)
    df = df.withColumns({c: F.lit(7) for c in ("key", "row", "code", "codes", "copies", "COUNT", "n", "best", "n_a")})
    compare(alignment.alignment_report(df), rows)


def test_empty_table(spark):
    out = alignment.alignment_report(spark.createDataFrame([], DOCS))
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] and out.count() == 0


def test_small_memory_and_joins_without_broadcast(spark, monkeypatch):
    """A pair table beyond the broadcast bound, and a cache that turns over in every batch, change nothing."""
    monkeypatch.setattr(alignment, "PAIR_BYTES", 0)
    rows = [(i, f"word{i % 7} and word{i % 5} or more") for i in range(60)]
    compare(alignment.alignment_report(spark.createDataFrame(rows, "doc_id long, text string")), rows)
    with open(alignment.BYTE_PATH, "rb") as one, open(alignment.PIECE_PATH, "rb") as two:
        files = one.read(), two.read()
    texts = [t for t in odd_texts() if t]
    plain = [x[:5] for x in alignment.Aligner(*files).batch(texts)]
    monkeypatch.setattr(alignment, "CACHE_BYTES", 2000)
    tight = alignment.Aligner(*files)
    assert [x[:5] for t in texts for x in tight.batch([t])] == plain


def test_long_groups_are_counted_by_distinct_ids():
    """A group of many tokens on both sides gives the same links as listing its occurrences."""
    with open(alignment.BYTE_PATH, "rb") as one, open(alignment.PIECE_PATH, "rb") as two:
        aligner = alignment.Aligner(one.read(), two.read())
    pair = next(i for i, t in aligner.a_bytes.items() if t == b"aa"), next(i for i, t in aligner.a_bytes.items() if t == b"a")
    other = [i for i, t in enumerate(aligner.b_bytes) if t in (b"a", b"aa")]
    single = next(i for i in other if aligner.b_bytes[i] == b"a")
    double = next(i for i in other if aligner.b_bytes[i] == b"aa")
    n = 200  # A: a aa aa ... a; B: aa aa ... aa - no common ends before the last
    row = aligner.aligned(b"a" * (2 * n), [pair[1], *[pair[0]] * (n - 1), pair[1]], [double] * (n - 1) + [double])
    n_a, n_b, n_groups, n_links, _, codes, counts = aligner.text_row([row])
    assert (n_a, n_b, n_groups, n_links) == (n + 1, n, 1, (n + 1) * n) and counts.sum() == n_links and single not in [c & 0xFFFF for c in codes.tolist()]
