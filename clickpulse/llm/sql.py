"""DuckDB twins of the registered queries."""

# Words of a text as the near-duplicate contract counts them.
_WORDS = r"regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[^\x20\x09-\x0D]+')"

OP10 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * shared >= 85 * (nx.n + ny.n - shared)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT e.y, r.seen FROM r JOIN e ON e.x = r.node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT node, min(seen) AS component_id FROM r GROUP BY node) c ON c.node = d.doc_id
"""

OP1 = r"""
WITH best AS (SELECT doc_id, max(quality) AS q FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
d AS (SELECT d.doc_id, d.source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        -ln((('0x' || substr(md5('17:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)
          / CASE q WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END AS key
      FROM documents d LEFT JOIN best ON best.doc_id = d.doc_id),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS n FROM d GROUP BY source),
w AS (SELECT source, source_size, CASE (n - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w, source_size * 2.0::DOUBLE AS most FROM s),
r AS (SELECT *, most / w AS ratio, sum(most) OVER o AS most_sum, sum(w) OVER o AS w_sum FROM w
      WINDOW o AS (ORDER BY most / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
t AS (SELECT sum(source_size)::DOUBLE AS total, sum(w) AS all_w FROM w),
l AS (SELECT min_by(level, ratio) AS level FROM (SELECT ratio, (1.5 * total - (most_sum - most)) / (all_w - (w_sum - w)) AS level FROM r, t) WHERE level <= ratio),
g AS (SELECT source, source_size, least(most, level * w) AS target FROM w, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM g),
f AS (SELECT d.*, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
        sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
c AS (SELECT source, max(upto) AS last FROM f WHERE size > 0 AND upto - size / 2.0 <= rest GROUP BY source)
SELECT f.doc_id, f.size, f.source_size, f.target,
       (f.size * (f.epochs + CASE WHEN f.upto <= coalesce(c.last, -1) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM f LEFT JOIN c ON f.source IS NOT DISTINCT FROM c.source
"""

OP2 = r"""
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""

OP3 = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
r AS (SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN regexp_matches(host, '(^|[.-])(adult|ads|bets|casino|pills|spam)([.-]|$)') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

# Terms of the lexical search's contract.
_TERMS = r"regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP12 = rf"""
WITH d AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
z AS (SELECT count(*)::BIGINT AS docs, sum(len(ts))::BIGINT AS length FROM d WHERE len(ts) > 0),
t AS (SELECT doc_id, len(ts)::BIGINT AS n, unnest(ts) AS term FROM d),
p AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM t GROUP BY ALL),
f AS (SELECT term, count(*)::BIGINT AS df FROM p GROUP BY term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM f, z),
i AS (SELECT item_id, term, count(*)::BIGINT AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // length))))::BIGINT AS score
  FROM i JOIN p USING (term) JOIN w USING (term), z GROUP BY item_id, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 20
"""
