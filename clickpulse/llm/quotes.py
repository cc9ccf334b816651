"""Quotation linking for chats (DataFrame functions only).

Quote levels are the ``>`` marks in front of a line. A passage is a run of lines of one level; its
normalised text is hashed and joined to what earlier messages of the conversation said in their own
words (whole messages, runs, paragraphs, lines, sentences). Messages are then ordered by reply: a message
that quotes another one follows in that one's thread, and the quotes are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.common import running_sums, written

MARKS = r"^(?:[ \t]*>)+[ \t]?"
# Lines like "On Monday Ann wrote:" in front of a quote belong to it.
ATTRIBUTION = r"(?:wrote|writes|said|schrieb|a écrit|escribió) ?:\s*$"
WHOLE = 1 << 40  # a whole passage outweighs any single line of it
MAX_ROUNDS = 40
SENTENCE_END = r"(?<=[.!?…。！？])[ ]?(?=\S)"  # in normalised text; line breaks do not end a sentence


def normalised(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def sentences(text: Column) -> Column:
    """Normalised sentences of a text, whatever its line breaks."""
    return F.transform(F.split(normalised(text), SENTENCE_END), lambda s: F.trim(s))


def _held(df: DataFrame, *cols: str | Column) -> DataFrame:
    """Keep the columns and compute the others once per row (the optimiser does not merge across the generator)."""
    plain = df.select(F.explode(F.array(F.struct(*cols))).alias("_h"))
    return plain.select("_h.*")


def parse(messages: DataFrame) -> DataFrame:
    """messages (conv_id, turn, role, text) -> those, msg (hash), clean (text without quotes), runs (level, lines).

    Null text counts as empty.
    """
    text = F.coalesce("text", F.lit(""))
    level = lambda x: F.length(F.regexp_replace(F.regexp_extract(x, r"^((?:[ \t]*>)*)", 1), "[^>]", ""))
    lines = F.transform(F.split(text, r"\r\n|\r|\n"), lambda x: F.struct(level(x).alias("level"), F.regexp_replace(x, MARKS, "").alias("body")))
    msg = F.md5(F.concat_ws("\u0001", F.coalesce("role", F.lit("\u0002")), F.coalesce("text", F.lit("\u0002"))))
    rows = _held(messages, "conv_id", "turn", "role", msg.alias("msg"), lines.alias("lines"), F.transform(lines, lambda x: x["level"]).alias("levels"))
    n = F.size("levels")
    starts = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (F.element_at("levels", i) != F.element_at("levels", F.greatest(i - 1, F.lit(1)))))
    own = F.filter("lines", lambda x, i: (x["level"] == 0) & ~(x["body"].rlike(ATTRIBUTION) & (F.coalesce(F.get(F.col("levels"), i + 1), F.lit(0)) > 0)))
    rows = _held(rows, "conv_id", "turn", "role", "msg", "levels", F.transform("lines", lambda x: x["body"]).alias("bodies"), starts.alias("starts"),
                 F.trim(F.array_join(F.transform(own, lambda x: x["body"]), "\n")).alias("clean"))
    end = lambda k: F.coalesce(F.get(F.col("starts"), k + 1), F.size("levels") + 1)
    runs = F.transform("starts", lambda s, k: F.struct(F.element_at("levels", s).alias("level"), F.slice(F.col("bodies"), s, end(k) - s).alias("lines")))
    return rows.select("conv_id", "turn", "role", "msg", "clean", runs.alias("runs"))


def said(parsed: DataFrame) -> DataFrame:
    """First turn of a conversation that says a text in its own words: conv_id, hash, first."""
    own = F.transform(F.filter("runs", lambda r: r["level"] == 0), lambda r: r["lines"])
    joined = F.transform(own, lambda x: F.array_join(x, "\n"))
    texts = F.concat(F.array(F.col("clean")), joined, F.flatten(F.transform(joined, lambda x: F.split(x, r"\n\s*\n"))), F.flatten(own),
                     F.flatten(F.transform(joined, sentences)))
    keys = F.array_distinct(F.transform(F.filter(F.transform(texts, normalised), lambda t: t != ""), lambda t: F.md5(t)))
    return parsed.select("conv_id", "turn", F.explode(keys).alias("hash")).groupBy("conv_id", "hash").agg(F.min("turn").alias("first"))


def quote_links(parsed: DataFrame) -> DataFrame:
    """conv_id, turn, msg, passage, level, original: the earliest earlier turn that said the passage (null: not found).

    The whole passage counts first; else its longest line or sentence that was said before.
    """
    quoted = parsed.select("conv_id", "turn", "msg", F.posexplode("runs").alias("passage", "run")).where("run.level > 0")
    quoted = quoted.select("conv_id", "turn", "msg", "passage", F.col("run.level").alias("level"), F.col("run.lines").alias("lines")).distinct()
    whole = normalised(F.array_join("lines", "\n"))
    tries = F.concat(F.array(F.struct((F.lit(WHOLE) + F.length(whole)).alias("weight"), whole.alias("text"))),
                     F.transform("lines", lambda x: F.struct(F.length(normalised(x)).cast("long").alias("weight"), normalised(x).alias("text"))),
                     F.transform(sentences(F.array_join("lines", "\n")), lambda x: F.struct(F.length(x).cast("long").alias("weight"), x.alias("text"))))
    one = quoted.select("conv_id", "turn", "msg", "passage", "level", F.explode(F.filter(tries, lambda t: t["text"] != "")).alias("try"))
    one = one.withColumn("hash", F.md5("try.text"))
    found = one.join(said(parsed), ["conv_id", "hash"]).where("first < turn")
    best = found.groupBy("conv_id", "turn", "msg", "passage").agg(F.max_by("first", F.struct(F.col("try.weight"), -F.col("first"))).alias("original"))
    best = best.select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "turn", "msg", "passage")], "original")
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & F.col("turn").eqNullSafe(F.col("_turn"))
    same &= (F.col("msg") == F.col("_msg")) & (F.col("passage") == F.col("_passage"))
    return quoted.join(best, same, "left").select("conv_id", "turn", "msg", "passage", "level", "original")


def threads(replies: DataFrame) -> DataFrame:
    """replies (conv_id, turn, reply_to < turn) -> conv_id, turn, thread: the turn at the start of the chain (pointer doubling)."""
    now = written(replies.groupBy("conv_id", "turn").agg(F.min("reply_to").alias("thread")), "threads")
    for _ in range(MAX_ROUNDS):
        up = now.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("above"))
        step = now.join(up, ["conv_id", "thread"], "left")
        if step.where("above is not null").isEmpty():
            return now
        now = written(step.select("conv_id", "turn", F.coalesce("above", "thread").alias("thread")), "threads")
    raise RuntimeError(f"reply chains are longer than 2^{MAX_ROUNDS}")


def reply_ordered(messages: DataFrame) -> DataFrame:
    """messages -> conv_id, turn, role, position, reply_to, thread, n_quotes, n_linked, text (without quotes); one row per row.

    reply_to is the original of the last linked passage of the lowest linked level; thread is where
    its chain of replies starts (the own turn without a reply); position counts from 1 within the
    conversation by (thread, turn, content). Rows without conv_id are one conversation without links;
    rows without turn come last and reply to nothing. Repeated rows stay and stand side by side.
    """
    parsed = written(parse(messages.select("conv_id", "turn", "role", "text")), "messages")
    links = written(quote_links(parsed), "quote-links")
    last = F.max_by("original", F.when(F.col("original").isNotNull(), F.struct(-F.col("level"), F.col("passage"))))
    replies = links.groupBy("conv_id", "turn", "msg").agg(last.alias("reply_to"), F.count("*").alias("n_quotes"), F.count("original").alias("n_linked"))
    chains = threads(replies.where("reply_to is not null").select("conv_id", "turn", "reply_to"))
    r = replies.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("msg").alias("_m"), "reply_to", "n_quotes", "n_linked")
    rows = parsed.drop("runs").join(r, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t")) & (F.col("msg") == F.col("_m")), "left").drop("_c", "_t", "_m")
    c = chains.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("thread").alias("start"))
    rows = rows.join(c, (F.col("conv_id") == F.col("_c")) & (F.col("turn") == F.col("_t")), "left")
    thread = F.when(F.col("reply_to").isNotNull(), F.col("start")).otherwise(F.col("turn"))
    rows = rows.select("conv_id", "turn", "role", "reply_to", thread.alias("thread"), F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
                       F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "msg", F.col("clean").alias("text"))
    order = [F.asc_nulls_last(x) for x in ("conv_id", "thread", "turn", "msg")]
    run = written(running_sums(rows, order, {"upto": F.lit(1)}, "reply-order"), "reply-positions")
    first = run.groupBy(F.col("conv_id").alias("_c")).agg((F.min("upto") - 1).alias("before"))
    run = run.join(first, F.col("conv_id").eqNullSafe(F.col("_c")))
    return run.select("conv_id", "turn", "role", (F.col("upto") - F.col("before")).alias("position"), "reply_to", "thread", "n_quotes", "n_linked", "text")
