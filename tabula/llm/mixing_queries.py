"""Query of the mixing operator over all documents, and its SQL."""

from __future__ import annotations

from tabula.session import load

from .mixing import mix_report
from .registry import query

SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), src AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight,
         source_size::DOUBLE * 3.0 AS cap FROM src
), lined AS (
  SELECT *, row_number() OVER o AS nth,
         coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS capped,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
         (sum(source_size) OVER ())::DOUBLE AS total
  FROM weighed WINDOW o AS (ORDER BY cap / weight, source ASC NULLS LAST)
), levels AS (
  SELECT *, (total - capped) / open AS level FROM lined
), lev AS (
  SELECT arg_min(level, nth) AS final FROM levels WHERE level * weight <= cap
), goal AS (
  SELECT source, source_size, CASE WHEN final IS NULL THEN cap ELSE least(cap, final * weight) END AS target
  FROM levels, lev
), goals AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM goal
), run AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.whole,
         floor(g.target + 0.5)::BIGINT - g.whole * g.source_size AS extra,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY md5('0:' || coalesce(s.doc_id::VARCHAR, 'null')), s.doc_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, extra - upto + size)))::BIGINT AS taken
FROM run
"""


@query("op2_mixing", SQL)
def op2_mixing(spark, sf_dir):
    return mix_report(load(spark, sf_dir, "documents"), seed=0)
