"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLDED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), told AS (
  SELECT conv_id, turn, role, text, role || chr(10) || text || chr(10) AS said,
         CASE WHEN role = 'assistant' THEN text ELSE '' END AS learned,
         22 + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + 2 AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(said, '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(length(learned)) AS BIGINT) AS loss_chars,
       sha256(string_agg(learned, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM told GROUP BY conv_id
"""

REPEATS = """
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), sized AS (SELECT *, CAST(length(h) // 2 AS BIGINT) AS n_bytes FROM docs),
windows AS (
  SELECT rid, p, md5(substr(h, 2 * p + 1, 400)) AS w
  FROM (SELECT rid, h, unnest(range(0, n_bytes - 199)) AS p FROM sized WHERE n_bytes >= 200)
), again AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
hit AS (SELECT rid, p FROM windows SEMI JOIN again USING (w)),
marked AS (SELECT rid, p, lag(p) OVER (PARTITION BY rid ORDER BY p) AS before FROM hit),
numbered AS (
  SELECT rid, p, sum(CASE WHEN before IS NULL OR p > before + 200 THEN 1 ELSE 0 END)
                 OVER (PARTITION BY rid ORDER BY p) AS run FROM marked
), runs AS (SELECT rid, run, min(p) AS a, max(p) + 200 AS b FROM numbered GROUP BY rid, run),
kept AS (
  SELECT rid, run, b AS a, coalesce(lead(a) OVER (PARTITION BY rid ORDER BY a), 1000000000) AS b FROM runs
  UNION ALL SELECT rid, 0, 0, min(a) FROM runs GROUP BY rid
), pieces AS (
  SELECT rid, string_agg(substr(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (b - a) AS BIGINT)), '' ORDER BY run) AS left_over
  FROM kept JOIN sized USING (rid) GROUP BY rid
), sums AS (SELECT rid, count(*) AS n_spans, sum(b - a) AS n_removed FROM runs GROUP BY rid)
SELECT doc_id, n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE coalesce(left_over, '') END)) AS kept_sha256
FROM sized LEFT JOIN sums USING (rid) LEFT JOIN pieces USING (rid)
"""

_WORDS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LEAKS = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
asked AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 9, 1))) AS i FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM asked),
places AS (
  SELECT rid, p, size, array_to_string(w[p + 1 : p + size], ' ') AS win
  FROM (SELECT rid, w, size, unnest(range(0, len(w) - size + 1)) AS p FROM docs, sizes WHERE len(w) >= size)
), found AS (SELECT rid, p, size, item_id FROM places JOIN asked USING (size, win)),
hit AS (SELECT rid, count(DISTINCT p + k) AS n_hit FROM (SELECT rid, p, unnest(range(0, size)) AS k FROM found) GROUP BY rid),
named AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT rid, item_id FROM found) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)
"""

NEGATIVES = """
WITH rows AS (
  SELECT row_number() OVER () AS n, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.n, a.vec_id AS anchor_id, b.n AS m, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.n <> b.n
  WHERE a.vec_id % 100 = 0
),
best AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id NULLS LAST, m) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.n, p.m ORDER BY s.score DESC, s.vec_id NULLS LAST, s.m)::INTEGER AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM best p JOIN scored s ON p.n = s.n
WHERE NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.n, p.m ORDER BY s.score DESC, s.vec_id NULLS LAST, s.m) <= 5
"""
