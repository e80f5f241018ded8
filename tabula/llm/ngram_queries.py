"""Query of the n-gram Jaccard join over all documents, and its SQL."""

from __future__ import annotations

from tabula.session import load

from .ngram_join import jaccard_components
from .registry import query

SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w
), n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s
), e AS (SELECT doc_id, unnest(s) AS g FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 75 * (na.n + nb.n - i)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a
)
SELECT n.doc_id, n.n AS n_shingles, c.component_id
FROM n JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""


@query("op3_ngram_join", SQL)
def op3_ngram_join(spark, sf_dir):
    return jaccard_components(load(spark, sf_dir, "documents").select("doc_id", "text"))
