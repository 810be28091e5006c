"""DuckDB SQL of the queries that SQL can state."""

URLS = r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
keyed AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, ':[0-9]*$', ''), '^www\.', '')
                 || regexp_replace(regexp_replace(path, '/+', '/', 'g'), '/$', '') END AS k
  FROM parts),
words(word) AS (VALUES
  -- ads and trackers
  ('ads'), ('adserver'), ('adservice'), ('clickbait'), ('popunder'), ('telemetry'), ('tracker'), ('trackers'), ('tracking'),
  -- adult
  ('adult'), ('adults'), ('escort'), ('escorts'), ('nsfw'), ('porn'), ('porno'), ('xxx'),
  -- fraud and malware
  ('malware'), ('phishing'), ('scam'), ('scams'), ('spam'), ('spyware'), ('warez'),
  -- gambling
  ('bet'), ('bets'), ('betting'), ('casino'), ('casinos'), ('gamble'), ('gambling'), ('jackpot'), ('poker'), ('roulette'), ('slots'),
  -- pills
  ('cialis'), ('pill'), ('pills'), ('steroids'), ('viagra')),
titled AS (
  SELECT page_id, replace(replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1),
           '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&') AS title
  FROM pages),
marked AS (
  SELECT substring(text, 1, 60) AS opening, coalesce(toxic, 0) = 1 AS toxic
  FROM documents JOIN labels USING (doc_id) WHERE length(substring(text, 1, 60)) >= 20),
bad_pages AS (
  SELECT page_id FROM titled WHERE title IN (SELECT opening FROM marked WHERE toxic EXCEPT SELECT opening FROM marked WHERE NOT toxic)
  UNION
  SELECT page_id FROM (SELECT page_id, unnest(regexp_split_to_array(host, '[.:-]')) AS word FROM parts) w JOIN words USING (word)),
spam AS (SELECT DISTINCT k FROM keyed JOIN bad_pages USING (page_id) WHERE k IS NOT NULL),
rules(rule, host_end, path_start, said) AS (VALUES
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'), ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
fits AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(said, length(rule)) AS said
  FROM keyed JOIN rules ON (host = host_end OR ends_with(host, '.' || host_end)) AND starts_with(path, path_start)
  GROUP BY page_id)
SELECT p.page_id, p.host, p.path, f.rule,
       coalesce(f.said, CASE WHEN s.k IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, s.k IS NOT NULL AS listed
FROM keyed p LEFT JOIN fits f USING (page_id) LEFT JOIN spam s ON p.k = s.k
"""

MIXING = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS k
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w,
         2.0::DOUBLE * source_size AS cap
  FROM sources),
tried AS (
  -- the level if exactly the sources of a smaller cap / weight were capped
  SELECT a.source, a.cap / a.w AS ratio,
         ((SELECT 1.5::DOUBLE * sum(source_size)::BIGINT FROM weighed)
          - coalesce((SELECT sum(b.cap) FROM weighed b WHERE b.cap / b.w < a.cap / a.w OR b.cap / b.w = a.cap / a.w AND b.source < a.source), 0.0))
         / ((SELECT sum(w) FROM weighed)
            - coalesce((SELECT sum(b.w) FROM weighed b WHERE b.cap / b.w < a.cap / a.w OR b.cap / b.w = a.cap / a.w AND b.source < a.source), 0.0)) AS level
  FROM weighed a),
water AS (SELECT arg_min(level, ratio) AS level FROM tried WHERE level <= ratio),
goals AS (
  SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * w) END AS target
  FROM weighed CROSS JOIN water),
placed AS (
  SELECT d.doc_id, d.size, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN floor(g.target)::BIGINT // g.source_size ELSE 0 END AS epochs,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - start)))::BIGINT AS taken
FROM placed
"""
