"""DuckDB SQL oracles for the registered queries.

Each query starts from the same adapter the Spark side uses
(``sources/testdata.py``), written here as CTEs over the driver's views.
"""

from __future__ import annotations

from clickpulse.plans import params as P

ADAPTER = """
ev AS (
  SELECT *, CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER) AS k FROM events
),
visits AS (
  SELECT CAST(ts AS DATE) AS date, user_id, 's' || CAST(user_id AS VARCHAR) AS session_id,
         CAST(k % 10 + 1 AS BIGINT) AS page_id, ts AS action_time,
         CASE WHEN event_type = 'click' THEN CAST(k % 20 + 1 AS BIGINT) ELSE -1 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN CAST(k + 1 AS BIGINT) ELSE -1 END AS click_product_id,
         CASE WHEN event_type = 'purchase'
              THEN CAST(k % 20 + 1 AS VARCHAR) || ',' || CAST((k + 7) % 20 + 1 AS VARCHAR) END AS order_category_ids,
         CASE WHEN event_type = 'signup'
              THEN CAST(k % 20 + 1 AS VARCHAR) || ',' || CAST((k + 11) % 20 + 1 AS VARCHAR) END AS pay_category_ids,
         CAST(event_id % 25 AS BIGINT) AS city_id, event_id
  FROM ev
),
users AS (
  SELECT CAST(c_custkey AS BIGINT) AS user_id, CAST(c_custkey % 50 + 10 AS INTEGER) AS age FROM customer
),
cities AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
products AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_id, p_name AS product_name FROM part
),
ads AS (
  SELECT e.event_id, e.ts,
         epoch_us(e.ts) // 1000 AS "timestamp",
         replace(c.area, ' ', '_') AS area, replace(c.city_name, ' ', '_') AS city,
         CAST(e.user_id AS VARCHAR) AS userid, CAST(e.k % 6 + 1 AS VARCHAR) AS adid,
         strftime(e.ts, '%Y-%m-%d') AS date
  FROM ev e JOIN cities c ON c.city_id = e.event_id % 25
)
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([ADAPTER.strip()] + [c.strip() for c in ctes]) + "\n"


FILTERED = f"""
fv AS (
  SELECT v.* FROM visits v JOIN users u ON v.user_id = u.user_id
  WHERE v.date >= DATE '{P.START_DATE}' AND v.date <= DATE '{P.END_DATE}'
    AND u.age >= {P.START_AGE} AND u.age <= {P.END_AGE}
)
"""

ACTS = """
acts AS (
  SELECT 'click' AS action, CAST(click_category_id AS VARCHAR) AS category FROM fv WHERE click_category_id <> -1
  UNION ALL
  SELECT 'order', c FROM (
    SELECT unnest(string_split(order_category_ids, ',')) AS c FROM fv
    WHERE click_category_id = -1 AND order_category_ids IS NOT NULL) WHERE trim(c) <> ''
  UNION ALL
  SELECT 'pay', c FROM (
    SELECT unnest(string_split(pay_category_ids, ',')) AS c FROM fv
    WHERE click_category_id = -1 AND order_category_ids IS NULL AND pay_category_ids IS NOT NULL) WHERE trim(c) <> ''
),
cc AS (
  SELECT category,
         count(*) FILTER (WHERE action = 'click') AS click,
         count(*) FILTER (WHERE action = 'order') AS "order",
         count(*) FILTER (WHERE action = 'pay') AS pay
  FROM acts GROUP BY category
),
top AS (
  SELECT * FROM cc ORDER BY click DESC, "order" DESC, pay DESC, category LIMIT {n}
)
""".replace("{n}", str(P.TOP_CATEGORIES))


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    q["visit_profile"] = _with() + """
SELECT count(*) AS "rows",
       strftime(min(action_time), '%Y-%m-%d %H:%M:%S') AS first_action,
       strftime(max(action_time), '%Y-%m-%d %H:%M:%S') AS last_action,
       CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date
FROM visits
"""

    q["visit_filter"] = _with(FILTERED) + """
SELECT user_id, session_id, page_id, CAST(date AS VARCHAR) AS date, event_id FROM fv
"""

    q["category_counts"] = _with(FILTERED, ACTS) + "SELECT * FROM cc\n"

    q["category_top10"] = _with(FILTERED, ACTS) + f"""
SELECT '{P.TASK_ID}' AS task_id, category, click, "order", pay FROM top
"""

    q["category_session_counts"] = _with(FILTERED) + """
SELECT click_category_id AS category, session_id, count(*) AS n
FROM fv WHERE click_category_id <> -1 GROUP BY 1, 2
"""

    q["category_session_top10"] = _with(FILTERED, ACTS) + f"""
SELECT '{P.TASK_ID}' AS task_id, category, session_id, n FROM (
  SELECT click_category_id AS category, session_id, count(*) AS n,
         row_number() OVER (PARTITION BY click_category_id ORDER BY count(*) DESC, session_id) AS rn
  FROM fv WHERE CAST(click_category_id AS VARCHAR) IN (SELECT category FROM top)
  GROUP BY 1, 2
) WHERE rn <= {P.TOP_SESSIONS}
"""
    q.update(_jump_sql())
    q["page_jump_ratio_hot"] = q["page_jump_ratio"]
    q["category_top10_sql"] = q["category_top10"]
    q["category_session_top10_sql"] = q["category_session_top10"]
    q["page_jump_ratio_sql"] = q["page_jump_ratio"]
    q["session_next_page_hot"] = q["session_next_page"]
    q.update(_area_sql())
    q["area_product_top3_sql"] = q["area_product_top3"]
    q.update(_ads_sql())
    # Streaming forms must equal their batch formulas.
    q["ads_guard_stream"] = _with(GUARD) + """
SELECT a.event_id, a.userid, a.adid, a.date
FROM ab a LEFT JOIN blk b USING (userid)
WHERE b.block_batch IS NULL OR a.batch_id <= b.block_batch
"""
    q["ads_guard_stream_blocked"] = _with(GUARD) + "SELECT userid FROM blk\n"
    q["city_click_share_sql"] = q["city_click_share"]
    q["stream_day_area_city_ads"] = q["ads_day_area_city_counts"]
    q["stream_day_area_top3"] = q["ads_day_area_top3"]
    q["stream_ads_minute_counts"] = q["ads_minute_counts"]
    q["stream_ads_last_hour_trend"] = q["ads_last_hour_trend"]
    q["stream_word_count"] = q["word_count"]
    q["stream_ads_sliding_counts"] = q["ads_sliding_counts"]
    # The whole app: Q7 / Q8 over the rows the guard accepts.
    acc = """
acc AS (
  SELECT a.* FROM ab a LEFT JOIN blk b USING (userid)
  WHERE b.block_batch IS NULL OR a.batch_id <= b.block_batch
)
"""
    q["ads_app_day_area_top3"] = _with(GUARD, acc, DAC.replace("FROM ads", "FROM acc")) + """
SELECT date, area,
       '[' || string_agg('{"' || adid || '":' || CAST(n AS VARCHAR) || '}', ',' ORDER BY rn) || ']' AS top_json
FROM top3 GROUP BY date, area
"""
    q["ads_app_last_hour_trend"] = _with(GUARD, acc, MINUTES.replace("FROM ads", "FROM acc")) + f"""
, nowm AS (SELECT max(minute) AS m FROM mc)
SELECT adid,
       '[' || string_agg('{{"' || strftime(minute, '%H:%M') || '":' || CAST(n AS VARCHAR) || '}}', ',' ORDER BY minute)
       || ']' AS trend_json
FROM mc, nowm
WHERE minute > m - INTERVAL {P.TREND_LENGTH_MINUTES} MINUTE AND minute <= m
GROUP BY adid
"""
    q["ads_app_inline_day_area_top3"] = q["ads_app_day_area_top3"]
    q["ads_app_inline_last_hour_trend"] = q["ads_app_last_hour_trend"]
    return q


def _flow_pages() -> list[str]:
    return [x.strip() for x in P.TARGET_PAGE_FLOW.split(",") if x.strip()]


NEXT = """
nx AS (
  SELECT session_id, event_id, page_id,
         lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS next_page
  FROM visits
)
"""


def _jump_sql() -> dict[str, str]:
    pages = _flow_pages()
    from_pages = ", ".join(pages[:-1])
    pairs = ", ".join(f"'{a}-{b}'" for a, b in zip(pages, pages[1:]))
    pc = f"""
pc AS (SELECT page_id, count(*) AS n FROM visits WHERE page_id IN ({from_pages}) GROUP BY page_id)
"""
    jc = f"""
jc AS (
  SELECT jump, count(*) AS n FROM (
    SELECT CAST(page_id AS VARCHAR) || '-' || CAST(next_page AS VARCHAR) AS jump FROM nx WHERE next_page IS NOT NULL
  ) WHERE jump IN ({pairs}) GROUP BY jump
)
"""
    return {
        "session_next_page": _with(NEXT) + "SELECT session_id, event_id, page_id, next_page FROM nx\n",
        "single_page_count": _with(pc) + "SELECT page_id, n FROM pc\n",
        "single_jump_count": _with(NEXT, jc) + "SELECT jump, n FROM jc\n",
        "page_jump_ratio": _with(NEXT, jc, pc) + f"""
SELECT '{P.TASK_ID}' AS task_id, jc.jump,
       CAST(jc.n AS DOUBLE) / CAST(coalesce(pc.n, 1) AS DOUBLE) AS ratio
FROM jc LEFT JOIN pc ON split_part(jc.jump, '-', 1) = CAST(pc.page_id AS VARCHAR)
""",
    }


AREA = """
ac AS (
  SELECT c.area, c.city_name, v.click_product_id
  FROM visits v JOIN cities c ON v.city_id = c.city_id WHERE v.click_product_id > 0
),
apc AS (SELECT area, click_product_id AS product_id, city_name, count(*) AS n FROM ac GROUP BY 1, 2, 3),
tot AS (SELECT area, product_id, sum(n) AS total FROM apc GROUP BY 1, 2),
top2 AS (
  SELECT area, product_id, city_name, n,
         row_number() OVER (PARTITION BY area, product_id ORDER BY n DESC, city_name) AS rn
  FROM apc WHERE city_name IS NOT NULL
  QUALIFY rn <= 2
),
pct AS (
  SELECT t.area, t.product_id, t.rn, t.city_name, floor(CAST(t.n AS DOUBLE) * 1000.0 / CAST(o.total AS DOUBLE) + 0.5) / 10.0 AS p
  FROM top2 t JOIN tot o USING (area, product_id)
),
share AS (
  SELECT o.area, o.product_id,
         coalesce(max(CASE WHEN p.rn = 1 THEN p.city_name || ':' || CAST(p.p AS VARCHAR) || '%,' END), '')
      || coalesce(max(CASE WHEN p.rn = 2 THEN p.city_name || ':' || CAST(p.p AS VARCHAR) || '%,' END), '')
      || '其他:' || CAST(floor((CAST(100.0 AS DOUBLE) - coalesce(max(CASE WHEN p.rn = 1 THEN p.p END), 0.0)
                                 - coalesce(max(CASE WHEN p.rn = 2 THEN p.p END), 0.0)) * 10.0 + 0.5) / 10.0 AS VARCHAR)
      || '%' AS city_click_ratio
  FROM tot o LEFT JOIN pct p USING (area, product_id)
  GROUP BY o.area, o.product_id
)
"""


def _area_sql() -> dict[str, str]:
    return {
        "area_city_clicks": _with(AREA) + "SELECT area, city_name, click_product_id FROM ac\n",
        "area_product_counts": _with(AREA)
        + "SELECT area, product_id, CAST(sum(n) AS BIGINT) AS product_count FROM apc GROUP BY 1, 2\n",
        "city_click_share": _with(AREA) + "SELECT area, product_id, city_click_ratio FROM share\n",
        "area_product_top3": _with(AREA) + f"""
, pp AS (SELECT area, product_id, sum(n) AS product_count FROM apc GROUP BY 1, 2),
ranked AS (
  SELECT pp.*, pr.product_name, rank() OVER (PARTITION BY pp.area ORDER BY pp.product_count DESC) AS rk
  FROM pp JOIN products pr USING (product_id)
)
SELECT '{P.TASK_ID}' AS task_id, r.area, r.product_name, CAST(r.product_count AS BIGINT) AS product_count,
       s.city_click_ratio
FROM ranked r JOIN share s USING (area, product_id) WHERE r.rk <= {P.TOP_PRODUCTS}
""",
    }


GUARD = f"""
ab AS (
  SELECT *, CAST(floor(date_diff('day', DATE '1970-01-01', CAST(date AS DATE)) / {P.GUARD_DAYS_PER_BATCH}) AS BIGINT)
         AS batch_id
  FROM ads
),
pb AS (SELECT date, userid, adid, batch_id, count(*) AS c FROM ab GROUP BY ALL),
run AS (
  SELECT *, sum(c) OVER (PARTITION BY date, userid, adid ORDER BY batch_id ROWS UNBOUNDED PRECEDING) AS cum FROM pb
),
blk AS (SELECT userid, min(batch_id) AS block_batch FROM run WHERE cum >= {P.GUARD_THRESHOLD} GROUP BY userid)
"""

DAC = f"""
dacc AS (SELECT date, area, city, adid, count(*) AS n FROM ads GROUP BY ALL),
dac AS (SELECT date, area, adid, CAST(sum(n) AS BIGINT) AS n FROM dacc GROUP BY ALL),
top3 AS (
  SELECT date, area, adid, n, row_number() OVER (PARTITION BY date, area ORDER BY n DESC, adid) AS rn
  FROM dac QUALIFY rn <= {P.TOP_ADS}
)
"""

MINUTES = """
mc AS (SELECT adid, date_trunc('minute', ts) AS minute, count(*) AS n FROM ads GROUP BY ALL)
"""


def _ads_sql() -> dict[str, str]:
    k = P.SLIDING_LENGTH_MINUTES // P.SLIDING_SLIDE_MINUTES
    slide_us = P.SLIDING_SLIDE_MINUTES * 60 * 1_000_000
    return {
        "ads_log_parse": _with() + 'SELECT event_id, "timestamp", area, city, userid, adid, date FROM ads\n',
        "ads_user_day_counts": _with() + "SELECT date, userid, adid, count(*) AS n FROM ads GROUP BY ALL\n",
        "ads_blacklist": _with() + f"""
SELECT DISTINCT userid FROM (SELECT userid, count(*) AS n FROM ads GROUP BY date, userid, adid)
WHERE n >= {P.GUARD_THRESHOLD}
""",
        "ads_blacklist_filter": _with() + f"""
SELECT event_id, userid, adid, date FROM ads
WHERE userid NOT IN (
  SELECT userid FROM ads GROUP BY date, userid, adid HAVING count(*) >= {P.GUARD_THRESHOLD})
""",
        "ads_guard_blocked": _with(GUARD) + "SELECT userid, block_batch FROM blk\n",
        "ads_guard_batches": _with(GUARD) + """
SELECT a.event_id, a.batch_id, a.userid, a.adid, a.date
FROM ab a LEFT JOIN blk b USING (userid)
WHERE b.block_batch IS NULL OR a.batch_id <= b.block_batch
""",
        "ads_day_area_city_counts": _with(DAC) + "SELECT date, area, city, adid, n FROM dacc\n",
        "ads_day_area_counts": _with(DAC) + "SELECT date, area, adid, n FROM dac\n",
        "ads_day_area_top3": _with(DAC) + """
SELECT date, area,
       '[' || string_agg('{"' || adid || '":' || CAST(n AS VARCHAR) || '}', ',' ORDER BY rn) || ']' AS top_json
FROM top3 GROUP BY date, area
""",
        "ads_minute_counts": _with(MINUTES) + "SELECT adid, strftime(minute, '%Y-%m-%d %H:%M') AS minute, n FROM mc\n",
        "ads_sliding_counts": _with() + f"""
, mb AS (SELECT adid, epoch_us(ts) // {slide_us} AS bucket, count(*) AS c FROM ads GROUP BY ALL),
sw AS (SELECT adid, bucket - r.range AS sb, c FROM mb CROSS JOIN range({k}) r)
SELECT adid,
       strftime(make_timestamp(sb * {slide_us}), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(make_timestamp(sb * {slide_us}) + INTERVAL {P.SLIDING_LENGTH_MINUTES} MINUTE, '%Y-%m-%d %H:%M:%S')
         AS window_end,
       CAST(sum(c) AS BIGINT) AS n
FROM sw GROUP BY adid, sb
""",
        "ads_last_hour_trend": _with(MINUTES) + f"""
, nowm AS (SELECT max(minute) AS m FROM mc)
SELECT adid,
       '[' || string_agg('{{"' || strftime(minute, '%H:%M') || '":' || CAST(n AS VARCHAR) || '}}', ',' ORDER BY minute)
       || ']' AS trend_json
FROM mc, nowm
WHERE minute > m - INTERVAL {P.TREND_LENGTH_MINUTES} MINUTE AND minute <= m
GROUP BY adid
""",
        "word_count": """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
WHERE word <> '' GROUP BY word
""",
    }
