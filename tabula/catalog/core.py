"""Flagship and LOCO bindings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.split import cohort_frame, loco_expand
from ..plans.loco_profile import ORACLE_SQL, cohort_view, loco_clip_scale_profile
from ..session import load
from .registry import query

COHORT_VIEW_SQL = """(SELECT c.c_custkey AS id, c.c_acctbal AS x, c.c_mktsegment AS segment, r.r_name AS cohort
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def cohorts_of(spark, sf):
    return cohort_view(load(spark, sf, "customer"), load(spark, sf, "nation"), load(spark, sf, "region"))


@query("loco_clip_scale_profile", "O-21+O-29+O-69+O-86", ORACLE_SQL)
def q_flagship(spark, sf):
    return loco_clip_scale_profile(cohorts_of(spark, sf))


@query(
    "loco_expand",
    "O-21",
    f"""SELECT b.id, f.fold,
       CASE WHEN CAST(b.cohort AS VARCHAR) IS NOT DISTINCT FROM f.fold THEN 'test' ELSE 'train' END AS role
FROM {COHORT_VIEW_SQL} b
CROSS JOIN (SELECT DISTINCT CAST(r_name AS VARCHAR) AS fold FROM region WHERE r_name IS NOT NULL) f""",
)
def q_loco_expand(spark, sf):
    return loco_expand(cohorts_of(spark, sf).select("id", "cohort"), "cohort").select("id", "fold", "role")


@query(
    "cohort_list",
    "O-109",
    f"SELECT DISTINCT CAST(cohort AS VARCHAR) AS cohort FROM {COHORT_VIEW_SQL} v WHERE cohort IS NOT NULL",
)
def q_cohort_list(spark, sf):
    return cohort_frame(cohorts_of(spark, sf), "cohort")
