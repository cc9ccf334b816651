"""Ad-click analytics, batch forms (jobs Q5-Q8).

These are the exact batch formulas of the streaming jobs in
``clickpulse.streaming``; the streaming tests compare against them.

Scale notes:
- every count is a partial + final hash aggregate (map-side combine), so a hot
  user / ad / city costs one row per map task before the shuffle;
- top-N per (date, area) uses ``row_number <= n`` (``WindowGroupLimit`` trims
  before the shuffle) and only collects the <= n survivors;
- sliding windows pre-aggregate per slide bucket and sweep over window edges, two rows a bucket
  however many windows it belongs to;
- the last-hour cut is a scalar subquery (one max), not a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse import constants as C
from clickpulse.functions.jsonpairs import pairs_json
from clickpulse.functions.timefmt import day_key, minute_label, minute_start, minute_text, ntz_of_epoch_millis
from clickpulse.operators.joins import materialized_side

FIELDS = ("timestamp", "area", "city", "userid", "adid")


def parse_ads_lines(lines: DataFrame, tz: str = "UTC", column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split wire lines ``"<epoch ms> <area> <city> <userid> <adid>"`` into typed rows.

    Returns ``(parsed, rejects)``. A line with fewer than five space-separated
    fields (trailing spaces make no field) or a non-integer timestamp goes to ``rejects`` with a reason instead of
    failing the job. Other input columns are carried through on ``parsed``.
    Adds ``ts`` (wall clock in ``tz``) and ``date`` (``yyyy-MM-dd``).
    """
    parts = F.split(F.rtrim(F.col(column)), " ")
    ms = F.try_element_at(parts, F.lit(1)).try_cast("bigint")
    reason = (
        F.when(F.col(column).isNull(), F.lit("null line"))
        .when(F.size(parts) < 5, F.lit("too few fields"))
        .when(ms.isNull(), F.lit("bad timestamp"))
    )
    keep = [c for c in lines.columns if c != column]
    tagged = lines.select(*keep, F.col(column), parts.alias("_p"), ms.alias("_ms"), reason.alias("_reason"))
    parsed = tagged.where(F.col("_reason").isNull()).select(
        *keep,
        F.col("_ms").alias("timestamp"),
        *[F.col("_p").getItem(i).alias(name) for i, name in enumerate(FIELDS) if i > 0],
    )
    ts = ntz_of_epoch_millis(F.col("timestamp"), tz)
    parsed = parsed.withColumn("ts", ts).withColumn("date", day_key(F.col("ts")))
    rejects = tagged.where(F.col("_reason").isNotNull()).select(F.col(column).alias("line"), F.col("_reason").alias("reason"))
    return parsed, rejects


def ads_user_day_counts(ads: DataFrame) -> DataFrame:
    """Clicks per (date, userid, adid)."""
    return ads.groupBy("date", "userid", "adid").agg(F.count(F.lit(1)).alias("n"))


def ads_blacklist(ads: DataFrame, threshold: int = C.BLOCK_THRESHOLD) -> DataFrame:
    """Users with at least ``threshold`` clicks on one ad in one day (distinct userid)."""
    return ads_user_day_counts(ads).where(F.col("n") >= threshold).select("userid").distinct()


def ads_blacklist_filter(ads: DataFrame, blocked: DataFrame) -> DataFrame:
    """Rows whose user is not blocked (``left_anti``; a null user id is kept).

    The blocked set grows with the data: it is materialised once and broadcast only
    when the bytes written are few, else a sort-merge anti join.
    """
    return ads.join(materialized_side(blocked.select("userid").distinct()), "userid", "left_anti")


def batch_of_day(date: Column, days_per_batch: int) -> Column:
    """Micro-batch number of a ``yyyy-MM-dd`` day: days since 1970-01-01 div ``days_per_batch``."""
    return F.floor(F.unix_date(F.to_date(date)) / F.lit(days_per_batch)).cast("long")


def ads_guard_blocked(ads: DataFrame, threshold: int = C.BLOCK_THRESHOLD, batch_col: str = "batch_id") -> DataFrame:
    """Batch formula of the stream guard: ``userid, block_batch``.

    A user is blocked after the first batch in which the running accepted count
    of some (date, user, ad) reaches ``threshold``. Until that batch all of the
    user's rows are accepted, so the running accepted count equals the running
    raw count; the window runs over per-batch counts (<= #batches rows per key).
    """
    per_batch = ads.groupBy("date", "userid", "adid", batch_col).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("date", "userid", "adid").orderBy(batch_col).rowsBetween(Window.unboundedPreceding, 0)
    running = per_batch.withColumn("cum", F.sum("c").over(w))
    return running.where(F.col("cum") >= threshold).groupBy("userid").agg(F.min(batch_col).alias("block_batch"))


def ads_guard_accepted(ads: DataFrame, threshold: int = C.BLOCK_THRESHOLD, batch_col: str = "batch_id") -> DataFrame:
    """Rows the stream guard accepts: the user is unblocked, or blocked in this batch or later.

    The per-user block table (one row per blocked user) is materialised once and
    broadcast when its files are small, so the rows themselves are not shuffled.
    """
    blocked = materialized_side(ads_guard_blocked(ads, threshold, batch_col))
    joined = ads.join(blocked, "userid", "left")
    return joined.where(F.col("block_batch").isNull() | (F.col(batch_col) <= F.col("block_batch"))).drop("block_batch")


def day_area_city_ad_counts(ads: DataFrame) -> DataFrame:
    """Clicks per (date, area, city, adid)."""
    return ads.groupBy("date", "area", "city", "adid").agg(F.count(F.lit(1)).alias("n"))


def day_area_ad_counts(city_counts: DataFrame) -> DataFrame:
    """Roll-up of per-city counts to (date, area, adid)."""
    return city_counts.groupBy("date", "area", "adid").agg(F.sum("n").cast("long").alias("n"))


def day_area_ad_top_n(area_counts: DataFrame, n: int = C.TOP_ADS) -> DataFrame:
    """Per (date, area) the ``n`` ads with most clicks (ties by adid) as JSON ``[{"ad":count},...]``."""
    w = Window.partitionBy("date", "area").orderBy(F.desc("n"), F.asc("adid"))
    best = area_counts.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
    lists = best.groupBy("date", "area").agg(F.array_sort(F.collect_list(F.struct("rn", F.col("adid").alias("k"), "n"))).alias("items"))
    return lists.select("date", "area", pairs_json(F.col("items")).alias("top_json"))


def ad_minute_counts(ads: DataFrame) -> DataFrame:
    """Clicks per (adid, minute); ``minute`` is a full ``timestamp_ntz`` key."""
    return ads.groupBy("adid", minute_start(F.col("ts")).alias("minute")).agg(F.count(F.lit(1)).alias("n"))


def ad_sliding_counts(ads: DataFrame, length_minutes: int = C.SLIDING_LENGTH_MINUTES,
                      slide_minutes: int = C.SLIDING_SLIDE_MINUTES) -> DataFrame:
    """Clicks per (adid, sliding window) aligned to the epoch like ``F.window(ts, length, slide)``.

    Rows are first counted per slide bucket; windows are then summed by a sweep over their edges.
    Only windows holding a click appear.
    """
    counts = ads.groupBy("adid", slide_bucket(F.col("ts"), slide_minutes).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return windows_of_buckets(counts, length_minutes, slide_minutes)


def slide_bucket(ts: Column, slide_minutes: int) -> Column:
    """Number of the slide bucket of a wall-clock time, counted from the epoch."""
    epoch_us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)
    return F.floor(epoch_us / F.lit(slide_minutes * 60 * 1_000_000)).cast("long")


def windows_of_buckets(counts: DataFrame, length_minutes: int, slide_minutes: int) -> DataFrame:
    """(adid, bucket, n) -> (adid, window_start, window_end, n) of the windows that hold the buckets."""
    if length_minutes % slide_minutes:
        raise ValueError("length must be a multiple of slide")
    k = length_minutes // slide_minutes
    # Sweep: the count of bucket b enters at window start b-k+1 and leaves at b+1, so a running sum over an
    # ad's edges is the count of every window that starts between two edges. Two rows a bucket, whatever k is.
    edges = counts.select("adid", F.inline(F.array(
        F.struct((F.col("bucket") - (k - 1)).alias("edge"), F.col("n").alias("d")), F.struct((F.col("bucket") + 1).alias("edge"), (-F.col("n")).alias("d")))))
    by_ad = Window.partitionBy("adid").orderBy("edge")
    upto = by_ad.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # Of edges at one place only the last has a next one beyond it.
    swept = edges.select("adid", "edge", F.sum("d").over(upto).cast("long").alias("n"), F.lead("edge").over(by_ad).alias("until"))
    runs = swept.where((F.col("n") > 0) & (F.col("until") > F.col("edge")))
    windows = runs.select("adid", "n", F.explode(F.sequence(F.col("edge"), F.col("until") - 1)).alias("start_bucket"))
    start = F.timestamp_add("MICROSECOND", F.col("start_bucket") * (slide_minutes * 60 * 1_000_000), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    end = F.timestamp_add("MINUTE", F.lit(length_minutes), start)
    return windows.select("adid", start.alias("window_start"), end.alias("window_end"), "n")


def ad_last_hour_trend(minute_counts: DataFrame, length_minutes: int = C.TREND_MINUTES,
                       now: Column | None = None) -> DataFrame:
    """Per ad the per-minute counts of the last ``length_minutes`` minutes as JSON ``[{"HH:mm":n},...]``.

    ``now`` (default: the latest minute in the data) closes the range; minutes in
    ``(now - length, now]`` are kept, ordered by time. At most ``length`` items per ad.
    """
    if now is None:
        now = minute_counts.select(F.max("minute")).scalar()
    cut = F.timestamp_add("MINUTE", F.lit(-length_minutes), now)
    recent = minute_counts.where((F.col("minute") > cut) & (F.col("minute") <= now))
    lists = recent.groupBy("adid").agg(
        F.array_sort(F.collect_list(F.struct("minute", minute_label(F.col("minute")).alias("k"), "n"))).alias("items")
    )
    return lists.select("adid", pairs_json(F.col("items")).alias("trend_json"))


def ad_recent_trend(ads: DataFrame, length_minutes: int = C.TREND_MINUTES) -> DataFrame:
    """``ad_last_hour_trend`` straight from the rows: the latest ``ts`` closes the range.

    Rows before the range are cut on ``date`` (folders of a partitioned table) and ``ts``
    before they are counted, so only the kept minutes are aggregated.
    """
    now = minute_start(ads.select(F.max("ts")).scalar())
    low = F.timestamp_add("MINUTE", F.lit(1 - length_minutes), now)
    recent = ads.where((F.col("date") >= day_key(low)) & (F.col("ts") >= low))
    return ad_last_hour_trend(ad_minute_counts(recent), length_minutes, now)


def ad_minute_rows(minute_counts: DataFrame) -> DataFrame:
    """Minute counts with a text key (for sinks and checks)."""
    return minute_counts.select("adid", minute_text(F.col("minute")).alias("minute"), "n")


def word_count(texts: DataFrame, column: str = "text", sep: str = " ") -> DataFrame:
    """Words (split on ``sep``, empty tokens dropped) with their counts over whole texts."""
    words = texts.select(F.explode(F.split(F.col(column), sep)).alias("word")).where(F.col("word") != "")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
