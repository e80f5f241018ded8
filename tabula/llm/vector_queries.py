"""Queries over all embeddings: near-duplicates by lattice hashing, exact top-k search; and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.session import load

from .lattice import near_duplicates
from .registry import query
from .topk import top_k

TOPK_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""

LINKS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
    AND len([1 FOR x IN embedding IF x <> 0]) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a
), c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""


@query("op7_lattice", LINKS_SQL)
def op7_lattice(spark, sf_dir):
    return near_duplicates(load(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query("op8_topk", TOPK_SQL)
def op8_topk(spark, sf_dir):
    found = top_k(load(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)
    return found.select(F.col("q_id").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
