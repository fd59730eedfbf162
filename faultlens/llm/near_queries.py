"""Near-duplicate groups of all documents."""

from faultlens.llm.near_dedup import near_duplicates
from faultlens.llm.registry import query, read

SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS s
  FROM words),
node AS (SELECT s, min(doc_id) AS node, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
gram AS (SELECT node, n, unnest(s) AS g FROM node),
common AS (
  SELECT a.node AS u, b.node AS v, a.n AS nu, b.n AS nv, count(*) AS i
  FROM gram a JOIN gram b ON a.g = b.g AND a.node < b.node AND a.n * 100 >= b.n * 85 AND b.n * 100 >= a.n * 85
  GROUP BY ALL),
link AS (SELECT u, v FROM common WHERE 100 * i >= 85 * (nu + nv - i)),
edge AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
reach AS (SELECT node AS a, node AS b FROM node UNION SELECT r.a, e.v FROM reach r JOIN edge e ON r.b = e.u),
comp AS (SELECT a AS node, min(b) AS c FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(c.c, s.doc_id) AS component_id, s.doc_id = coalesce(c.c, s.doc_id) AS kept
FROM sets s LEFT JOIN node n ON n.s = s.s LEFT JOIN comp c ON c.node = n.node
"""


@query("op1_near_duplicates", SQL)
def op1_near_duplicates(spark, sf_dir):
    """The group of every document, with three-word shingles and a similarity of 0.85; null and empty texts are groups of their own."""
    return near_duplicates(read(spark, sf_dir, "documents"), width=3, percent=85)
