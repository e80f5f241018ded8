"""Flagship: leave-one-cohort-out clip-and-scale profile.

entity table ⋈ cohort lookup → LOCO folds (O-21) → train quartiles per fold
(O-29) → clip both roles to Q1/Q3 (O-69) → z-score with train mean/std (O-86)
→ one row per (fold, role): n, mean and std of the scaled value. The folds are
never materialised as row copies: see ``loco_clip_scale_profile``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..operators.split import cohort_list, loco_quantiles


def cohort_view(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """(id, x, segment, cohort): entities with their cohort name.

    nation/region are dimension tables; the planner broadcasts them by their
    measured size (AQE), the entity table is never shuffled for these joins.
    """
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_acctbal").alias("x"),
            F.col("c_mktsegment").alias("segment"),
            F.col("r_name").alias("cohort"),
        )
    )


def loco_clip_scale_profile(base: DataFrame, id_col: str = "id", value: str = "x", cohort: str = "cohort") -> DataFrame:
    """One row per (fold, role): n, mean and std of the clipped, train-standardised value.

    No row is copied per fold. Train quartiles per fold come from
    :func:`loco_quantiles` (global buckets, per-cohort bucket statistics combined
    as "all cohorts but f"). Clipping with each fold's literal bounds and the
    per-(fold, role) count/mean/std are then one aggregation pass with 6k
    conditional aggregates; z = (x − μ_train)/σ_train is linear, so
    mean(z) = (mean − μ)/σ and std(z) = std/σ follow exactly.
    """
    spark = base.sparkSession
    cohorts = cohort_list(base, cohort)
    q = {r["fold"]: (r["q1"], r["q3"]) for r in
         loco_quantiles(base, cohort, value, [0.25, 0.75], cohorts, ["q1", "q3"]).collect()}
    c = F.col(cohort).cast("string")
    x = F.col(value).cast("double")
    aggs = []
    for i, f in enumerate(cohorts):
        q1, q3 = q[f]
        iqr = q3 - q1
        clipped = F.when(x < F.lit(q1 - 1.5 * iqr), F.lit(q1)).when(x > F.lit(q3 + 1.5 * iqr), F.lit(q3)).otherwise(x)
        is_test = c.eqNullSafe(F.lit(f))
        for role, cond in (("train", ~is_test), ("test", is_test)):
            v = F.when(cond, clipped)
            aggs += [F.count(v).alias(f"n{i}{role}"), F.avg(v).alias(f"m{i}{role}"), F.stddev_samp(v).alias(f"s{i}{role}")]
    r = base.agg(*aggs).first()
    rows = []
    for i, f in enumerate(cohorts):
        mu, sd = r[f"m{i}train"], r[f"s{i}train"]
        for role in ("train", "test"):
            n, m, s = r[f"n{i}{role}"], r[f"m{i}{role}"], r[f"s{i}{role}"]
            if sd is not None and sd > 0:
                mz = None if m is None else (m - mu) / sd
                sz = None if s is None else s / sd
            else:
                mz, sz = m, s
            rows.append((f, role, int(n), mz, sz))
    out = spark.createDataFrame(rows, "fold string, role string, n long, mean_z double, std_z double")
    return out.select("fold", "role", "n", r6("mean_z").alias("mean_z"), r6("std_z").alias("std_z"))


ORACLE_SQL = """
WITH base AS (
  SELECT c.c_custkey AS id, c.c_acctbal AS x, r.r_name AS cohort
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
cohorts AS (SELECT DISTINCT CAST(cohort AS VARCHAR) AS fold FROM base WHERE cohort IS NOT NULL),
folds AS (
  SELECT b.id, b.x, f.fold,
         CASE WHEN CAST(b.cohort AS VARCHAR) IS NOT DISTINCT FROM f.fold THEN 'test' ELSE 'train' END AS role
  FROM base b CROSS JOIN cohorts f),
q AS (SELECT fold, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3
      FROM folds WHERE role = 'train' GROUP BY fold),
clipped AS (
  SELECT f.fold, f.role,
         CASE WHEN f.x < q.q1 - 1.5 * (q.q3 - q.q1) THEN q.q1
              WHEN f.x > q.q3 + 1.5 * (q.q3 - q.q1) THEN q.q3 ELSE f.x END AS x
  FROM folds f JOIN q USING (fold)),
fit AS (SELECT fold, avg(x) AS mu, stddev_samp(x) AS sd FROM clipped WHERE role = 'train' GROUP BY fold),
z AS (SELECT c.fold, c.role, CASE WHEN fit.sd > 0 THEN (c.x - fit.mu) / fit.sd ELSE c.x END AS z
      FROM clipped c JOIN fit USING (fold))
SELECT fold, role, CAST(count(*) AS BIGINT) AS n,
       round(avg(z), 6) + 0.0 AS mean_z, round(stddev_samp(z), 6) + 0.0 AS std_z
FROM z GROUP BY fold, role
"""
