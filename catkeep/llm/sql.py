"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

UPPER_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

SQL: dict[str, str] = {}

SQL["op1_url_filter"] = rf"""
WITH cut AS (
  SELECT page_id,
         CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest
  FROM pages
), parts AS (
  SELECT page_id, rest,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*'), {UPPER_LOWER}), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         list_sort(list_filter(string_split(coalesce(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), ''), '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS kept
  FROM cut
), named AS (
  SELECT page_id, host, path,
         CASE WHEN rest IS NOT NULL THEN
           regexp_replace(regexp_replace(host, '^[^@]*@', ''), ':(80|443)$', '')
           || regexp_replace(path, '/+$', '')
           || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END
         END AS canonical
  FROM parts
), rules(verdict, rhost, rpath) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fitting AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM named JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id
), listed AS (
  SELECT DISTINCT canonical FROM named
  WHERE regexp_matches(host, '(^|\.)[a-z0-9-]*(casino|bets|pills|ads-track)[a-z0-9-]*\.') AND canonical IS NOT NULL
)
SELECT n.page_id, host, path, f.rule,
       coalesce(f.verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       n.canonical, l.canonical IS NOT NULL AS listed
FROM named n LEFT JOIN fitting f USING (page_id) LEFT JOIN listed l ON n.canonical = l.canonical
"""

SQL["op5_threshold_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_dot_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 20
"""

SQL["op6_stream_dedup"] = r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents
), k AS (
  SELECT norm, count(*) AS group_size, first(doc_id ORDER BY length(t) DESC, doc_id) AS keep_id
  FROM n GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM n JOIN k USING (norm)
"""

SQL["op8_line_dedup"] = r"""
WITH parts AS (
  SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), l AS (
  SELECT doc_id, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM parts
), spread AS (
  SELECT trim(line, ' ') AS line FROM l WHERE trim(line, ' ') <> ''
  GROUP BY trim(line, ' ') HAVING count(DISTINCT source) >= 10
), marked AS (
  SELECT l.*, s.line IS NOT NULL AS removed FROM l LEFT JOIN spread s ON trim(l.line, ' ') = s.line
), docs AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE removed) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT removed), '') AS kept
  FROM marked GROUP BY doc_id
)
SELECT doc_id, n_lines, n_removed, length(kept) AS kept_chars, sha256(kept) AS kept_sha256 FROM docs
"""

SQL["op9_warc_revisit"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_page THEN first_page END AS refers_to
FROM f
"""

SQL["op13_term_search"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), {UPPER_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), sizes AS (
  SELECT row_no, doc_id, len(words) AS n FROM d
), totals AS (
  SELECT count(*) FILTER (WHERE n > 0) AS docs, sum(n)::BIGINT AS total FROM sizes
), counted AS (
  SELECT row_no, term, count(*) AS tf FROM (SELECT row_no, unnest(words) AS term FROM d) GROUP BY ALL
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {UPPER_LOWER}),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0 * max(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM counted, totals GROUP BY term
), scores AS (
  SELECT item_id, row_no, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counted USING (term) JOIN sizes USING (row_no), totals
  GROUP BY item_id, row_no, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 50
"""
