"""Page-to-page jump conversion along a target page flow (job Q3).

``session_next_page`` is the hard part at scale: pages must be paired in session order, and one
session (or the null session) may hold a large share of all rows.

1. ``slices.session_cuts`` sketches where long sessions must be cut (one pass, a few numbers).
2. ``lead`` within (session, slice): a group is about one slice at most. One shuffle.
3. The last row of a slice takes the first page of the session's next slice. First pages are found
   in a second pass over the rows of cut sessions; there are about as many as slices, so they are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.functions.idlists import adjacent_pairs
from clickpulse.operators.slices import SLICE, session_cuts, with_slices


def _flow(flow: str | list) -> list[str]:
    items = flow.split(",") if isinstance(flow, str) else [str(x) for x in flow]
    return [x.strip() for x in items if x.strip()]


def tie_break(visits: DataFrame) -> list[str]:
    """Columns that order visits of one session and time: event_id, or else all other columns by name."""
    if "event_id" in visits.columns:
        return ["event_id"]
    return sorted(c for c in visits.columns if c not in ("session_id", "action_time"))


def session_next_page(visits: DataFrame, slices: int | None = None) -> DataFrame:
    """Each visit with the page of the next visit in its session (null for the last).

    Order inside a session is (action_time, event_id); without ``event_id`` the remaining columns
    break ties, so rows equal in all of them are interchangeable. Rows without a session are one
    session. Returns ``session_id, page_id, action_time``, ``event_id`` if there is one, ``next_page``.
    ``slices`` (default: the shuffle partitions) is the number of parts into which all rows would be
    cut; rows of one session and second stay together. Building the result runs one small job, the
    sketch, and writes nothing.
    """
    ties = tie_break(visits)
    keyed = visits.select(*dict.fromkeys(["session_id", "page_id", "action_time", *ties]))
    n = slices or int(visits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = session_cuts(visits, "session_id", "action_time", n)
    w = Window.partitionBy("session_id", SLICE).orderBy("action_time", *ties)
    local = with_slices(keyed, "session_id", "action_time", cuts).select(
        "*", F.lead("page_id").over(w).alias("next_page"), F.lead(F.lit(1)).over(w).isNull().alias("_tail"))
    first = F.min(F.struct("action_time", *ties, F.col("page_id").alias("_page")))
    heads = with_slices(keyed, "session_id", "action_time", cuts, only_cut=True).groupBy("session_id", SLICE).agg(first.alias("_first"))
    following = F.lead("_first._page").over(Window.partitionBy("session_id").orderBy(SLICE))
    links = heads.select(F.col("session_id").alias("_of"), F.col(SLICE).alias("_at"), following.alias("_link"))
    joined = local.join(F.broadcast(links), F.col("session_id").eqNullSafe(F.col("_of")) & (F.col(SLICE) == F.col("_at")), "left")
    kept = [c for c in ("session_id", "page_id", "action_time", "event_id") if c in keyed.columns]
    return joined.select(*kept, F.when(F.col("_tail"), F.col("_link")).otherwise(F.col("next_page")).alias("next_page"))


def single_page_count(visits: DataFrame, flow: str | list) -> DataFrame:
    """Visits per page for the flow's from-pages (all but the last page)."""
    pages = [int(p) for p in _flow(flow)[:-1]]
    return visits.where(F.col("page_id").isin(pages)).groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))


def jump_pairs(next_pages: DataFrame, flow: str | list) -> DataFrame:
    """Adjacent (page, next_page) rows restricted to the flow's consecutive pairs."""
    pairs = adjacent_pairs(_flow(flow))
    jump = F.concat_ws("-", F.col("page_id").cast("string"), F.col("next_page").cast("string"))
    return next_pages.where(F.col("next_page").isNotNull()).select(jump.alias("jump")).where(F.col("jump").isin(pairs))


def single_jump_count(visits: DataFrame, flow: str | list, slices: int | None = None) -> DataFrame:
    """Occurrences of each flow pair ``"a-b"`` as consecutive visits in a session."""
    nx = session_next_page(visits, slices)
    return jump_pairs(nx, flow).groupBy("jump").agg(F.count(F.lit(1)).alias("n"))


def page_jump_ratio(
    visits: DataFrame, flow: str | list, task_id: str | None = None, slices: int | None = None,
) -> DataFrame:
    """``jump, ratio`` = jumps a->b / visits of a (denominator 1 when a has no visits).

    Pairs that never occur are absent; the denominator counts every visit of the
    from-page, including the last one of a session.
    """
    jumps = single_jump_count(visits, flow, slices)
    pages = single_page_count(visits, flow).select(F.col("page_id").cast("string").alias("from_page"), F.col("n").alias("den"))
    ratio = (
        jumps.withColumn("from_page", F.split("jump", "-").getItem(0))
        .join(pages, "from_page", "left")
        .select("jump", (F.col("n").cast("double") / F.coalesce(F.col("den"), F.lit(1)).cast("double")).alias("ratio"))
    )
    if task_id is None:
        import uuid

        task_id = str(uuid.uuid4())
    return ratio.select(F.lit(task_id).alias("task_id"), "jump", "ratio")
