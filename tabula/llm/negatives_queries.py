"""Query of hard-negative mining over all embeddings and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabula.session import load

from .hard_negatives import hard_negatives
from .registry import query

NEGATIVES_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, c.r AS c, c.vec_id AS id, a.label = c.label AS same,
    list_dot_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.r <> c.r AND len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0
), p AS (
  SELECT a, anchor_id, c AS p, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id, c) <= 5
), n AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.p ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON p.a = s.a AND NOT s.same
    AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


@query("op12_hard_negatives", NEGATIVES_SQL)
def op12_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(load(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=moved)
