"""DuckDB SQL for the queries of this package that SQL can express."""

SQL: dict[str, str] = {}

SQL["op7_url_filter"] = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages),
parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/')
      THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/')
      THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
    END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

SQL["op5_ngram_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE
    WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')))
    END AS shingles
  FROM w),
t AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM t a JOIN t b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
  SELECT x, y FROM links
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles,
       least(s.doc_id, coalesce((SELECT min(y) FROM reach WHERE reach.x = s.doc_id), s.doc_id))
         AS component_id
FROM s
"""

SQL["op11_mixing"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 8)
              AS BIGINT) AS draw
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1] AS DOUBLE)
           AS weight
  FROM d GROUP BY source),
-- in order of size over weight, the sources that reach their limit come first
filled AS (
  SELECT *, 2.0 * source_size < (1.5 * sum(source_size) OVER () - 2.0 * (sum(source_size) OVER w - source_size))
              * weight / (sum(weight) OVER () - (sum(weight) OVER w - weight)) AS held
  FROM s WINDOW w AS (ORDER BY source_size / weight, source ROWS UNBOUNDED PRECEDING)),
level AS (
  SELECT 1.5 * sum(source_size) - coalesce(sum(2.0 * source_size) FILTER (held), 0.0) AS words,
         coalesce(sum(weight) FILTER (NOT held), 1.0) AS weights
  FROM filled),
targets AS (
  SELECT source, source_size, CASE WHEN held THEN 2.0 * source_size ELSE words * weight / weights END AS target
  FROM filled, level),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 2.0) ELSE 0.0 END AS rate FROM targets),
turns AS (SELECT j, (j * 2654435769) % 4294967296 AS turn FROM range(32) r(j)),
taken AS (
  SELECT r.source, j, turn,
         abs(floor(any_value(rate)) * any_value(source_size) + sum(CASE
           WHEN (draw + turn) % 4294967296 < (rate - floor(rate)) * 4294967296.0 THEN size ELSE 0 END)
           - any_value(target)) AS off
  FROM d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source, turns
  GROUP BY r.source, j, turn),
chosen AS (SELECT source, arg_min(turn, (off, j)) AS turn FROM taken GROUP BY source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (floor(rate) + CAST((draw + turn) % 4294967296 < (rate - floor(rate)) * 4294967296.0 AS INT))
            AS BIGINT) AS taken
FROM d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source
"""

SQL["op13_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
t AS (SELECT d, lang, source, unnest(ts) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
used AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
grid AS (
  SELECT g.lang, g.source, k.term, k.lang_n, coalesce(u.n, 0) AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g JOIN kept k ON g.lang = k.lang
  LEFT JOIN used u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term),
totals AS (SELECT lang, source, sum(n) AS total FROM grid GROUP BY lang, source),
shares AS (
  SELECT lang, source, term, n,
         1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS p,
         1 + (1000000000::HUGEINT * (lang_n + 2)) // (lang_total + 2 * v) AS q
  FROM grid JOIN totals USING (lang, source) JOIN langs USING (lang)),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, (
           SELECT coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0)
           FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term
           WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source) AS value
  FROM (SELECT DISTINCT lang, source FROM docs) a JOIN (SELECT DISTINCT lang, source FROM docs) b
    ON a.lang = b.lang AND a.source <> b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS r
  FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR r <= 10
"""
