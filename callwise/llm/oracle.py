"""DuckDB twins of the corpus queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op2_line_dedup"] = """
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
w AS (
  SELECT doc_id, pos, ls[pos] AS a, ls[pos + 1] AS b, ls[pos + 2] AS c
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) - 1)) AS pos FROM l)
),
r AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS rn
  FROM w WHERE NOT (trim(a) = '' AND trim(b) = '' AND trim(c) = '')
),
covered AS (SELECT DISTINCT doc_id, pos + unnest([0, 1, 2]) AS line FROM r WHERE rn > 1),
x AS (SELECT doc_id, len(ls) AS n_lines, ls, unnest(range(1, len(ls) + 1)) AS line FROM l)
SELECT x.doc_id, any_value(n_lines) AS n_lines, count(covered.line) AS n_removed,
       coalesce(string_agg(ls[x.line], chr(10) ORDER BY x.line) FILTER (covered.line IS NULL), '') AS text
FROM x LEFT JOIN covered ON x.doc_id = covered.doc_id AND x.line = covered.line
GROUP BY x.doc_id
"""

ORACLE["op10_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)
"""

# double precision throughout; UNION makes the walk along links end
ORACLE["op5_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
),
reach AS (SELECT vec_id, vec_id AS other FROM v UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
component AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
degree AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, e.vec_id) AS component_id,
       coalesce(component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN component USING (vec_id) LEFT JOIN degree USING (vec_id)
"""

# integer scores are exact in double precision
ORACLE["op13_hard_negatives"] = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS INTEGER) AS "rank",
       s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.a = s.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) <= 5
"""
