"""SQL that gives the rows of those queries that SQL can express."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex({LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM w
), size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM shared JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * k >= 75 * (p.n + q.n - k)
), reach AS (
  SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT reach.d, link.b FROM reach JOIN link ON link.a = reach.r
), least AS (SELECT d, min(r) AS component_id FROM reach GROUP BY d)
SELECT d AS doc_id, coalesce(n, 0) AS n_shingles, component_id, d = component_id AS kept
FROM least LEFT JOIN size ON size.doc_id = d
"""

CONTAMINATION = f"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex({LOWER.format("coalesce(text, '')")}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT item_id, list_filter(string_split_regex({LOWER.format("coalesce(text, '')")}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, unnest(CASE
    WHEN len(w) >= 10 THEN list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s, least(len(w), 10) AS k
  FROM b
), lens AS (SELECT DISTINCT k FROM win
), grams AS (
  SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM d, lens WHERE len(w) >= k
), hit AS (
  SELECT g.doc_id, g.i, g.k, win.item_id FROM grams g JOIN win ON win.k = g.k AND win.s = array_to_string(g.w[g.i:g.i + g.k - 1], ' ')
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hit GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

TOOL_CALLS = """
WITH RECURSIVE c AS (
  SELECT conv_id, turn, struct_pack(role := role, text := text) AS b, count(*) AS copies,
    row_number() OVER (PARTITION BY conv_id, turn ORDER BY role NULLS FIRST, CAST(to_json(text) AS VARCHAR) NULLS FIRST) AS place,
    count(*) OVER (PARTITION BY conv_id, turn) AS variants
  FROM conversations WHERE role <> 'assistant' OR role IS NULL GROUP BY conv_id, turn, role, text
), n AS (
  SELECT conv_id, turn FROM c WHERE place = 1
), r AS (
  SELECT conv_id, turn - 1 AS turn, text AS content, count(*) AS n_results FROM conversations WHERE role = 'assistant' GROUP BY ALL
), depth AS (
  SELECT conv_id, turn, CAST(0 AS BIGINT) AS depth FROM n WHERE (conv_id, turn - 2) NOT IN (SELECT conv_id, turn FROM n)
  UNION ALL SELECT n.conv_id, n.turn, depth + 1 FROM depth JOIN n ON n.conv_id = depth.conv_id AND n.turn = depth.turn + 2
), rows AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, 'call-' || coalesce(c.turn, r.turn) AS call_id, depth, c.turn AS turn, b, content, place,
    coalesce(copies, 0) AS copies, coalesce(n_results, 0) AS n_results,
    concat_ws(',', CASE WHEN c.turn IS NULL THEN 'no call' WHEN b.role = 'user' THEN NULL WHEN b.role = 'system' THEN 'unknown follows' ELSE 'unknown tool' END,
      CASE WHEN variants > 1 THEN 'conflict' END) AS errors
  FROM c LEFT JOIN depth ON depth.conv_id = c.conv_id AND depth.turn = c.turn
  FULL JOIN r ON r.conv_id = c.conv_id AND r.turn = c.turn AND place = 1
)
SELECT conv_id, call_id, depth, CASE WHEN turn IS NULL THEN 'orphan' WHEN place > 1 THEN 'conflict' WHEN n_results = 0 THEN 'unanswered' ELSE 'linked' END AS status,
  copies, n_results, errors = '' AS valid, errors,
  CASE WHEN turn IS NOT NULL THEN '{"arguments":{"follows":' || CASE WHEN turn > 0 THEN 'true' ELSE 'false' END || ',"query":' || CAST(to_json(b.text) AS VARCHAR)
    || ',"turn":' || turn || '},"id":"' || call_id || '","name":"' || b.role || '","type":"call"}' END AS call_json,
  CASE WHEN n_results > 0 THEN '{"content":' || CAST(to_json(content) AS VARCHAR) || ',"id":"' || call_id || '","type":"result"}' END AS result_json
FROM rows
"""
