"""Bindings: composite reports (QC recommendations, bias profile, expression matrix)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..operators import stats as S
from ..plans.bias import age_group, bias_profile
from ..plans.qc import qc_recommendations
from ..session import load
from .core import COHORT_VIEW_SQL, cohorts_of
from .profiles import embeddings_long
from .registry import query
from .sqlgen import EMB_LONG_SQL
from .sqlgen import r6 as s6

QC_EVENTS_SQL = """(SELECT event_id, ts, user_id, event_type, value, props,
  CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS kind,
  CASE WHEN value > 25 THEN 'Yes' ELSE 'no' END AS big FROM events)"""


def qc_events(spark, sf):
    e = load(spark, sf, "events")
    return e.select(
        "event_id", "ts", "user_id", "event_type", "value", "props",
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind"),
        F.when(F.col("value") > 25, "Yes").otherwise("no").alias("big"),
    )


def _qc_sql() -> str:
    num = ["event_id", "user_id", "value"]
    cat = ["event_type", "props", "kind", "big"]
    allc = ["event_id", "ts", "user_id", "event_type", "value", "props", "kind", "big"]
    pos = {c: i for i, c in enumerate(allc)}
    miss = " UNION ALL ".join(
        f"SELECT {pos[c]} AS pos, '{c}' AS col, count(*) - count({c}) > 0 AS f FROM e" for c in allc
    )
    outl = " UNION ALL ".join(
        f"""SELECT {pos[c]} AS pos, '{c}' AS col, (SELECT count(*) FROM e, (SELECT quantile_cont({c}, 0.25) AS q1,
  quantile_cont({c}, 0.75) AS q3 FROM e) q WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) > 0 AS f"""
        for c in num
    )
    card = " UNION ALL ".join(
        f"SELECT {pos[c]} AS pos, '{c}' AS col, count(DISTINCT lower(trim({c}))) > 20 AS f FROM e" for c in cat
    )
    boo = " UNION ALL ".join(
        f"""SELECT {pos[c]} AS pos, '{c}' AS col, count(DISTINCT lower(trim({c}))) = 2
  AND coalesce(bool_or(lower(trim({c})) IN ('positive', '+', 'yes', '1')), false) AS f FROM e""" for c in cat
    )

    def names(sub):
        return f"(SELECT coalesce(string_agg(col, ', ' ORDER BY pos) FILTER (WHERE f), '') FROM ({sub}))"

    dup = "(SELECT count(*) - count(DISTINCT user_id) - max(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) FROM e)"
    return f"""WITH e AS {QC_EVENTS_SQL}
SELECT CAST(0 AS BIGINT) AS line_no, 'Recommended preprocessing strategy based on QC:' AS text
UNION ALL SELECT 1, CASE WHEN {dup} > 0 THEN '- Remove or review ' || CAST({dup} AS VARCHAR)
  || ' duplicate rows based on user_id.' ELSE '- No duplicate row cleanup required.' END
UNION ALL SELECT 2, CASE WHEN length({names(miss)}) > 0 THEN '- Impute or handle missing values in columns: '
  || {names(miss)} || '.' ELSE '- No missing-value imputation required.' END
UNION ALL SELECT 3, CASE WHEN length({names(outl)}) > 0 THEN '- Consider robust scaling/capping for outliers in: '
  || {names(outl)} || '.' ELSE '- No strong outlier treatment indicated by IQR rule.' END
UNION ALL SELECT 4, CASE WHEN length({names(card)}) > 0 THEN '- High-cardinality categorical columns detected ('
  || {names(card)} || '); consider target/frequency encoding.'
  ELSE '- Categorical cardinality is manageable for standard encoding.' END
UNION ALL SELECT 5, CASE WHEN length({names(boo)}) > 0 THEN '- Converted to boolean: ' || {names(boo)} || '.'
  ELSE '- No categorical columns met the boolean-cast rule.' END
UNION ALL SELECT 6, 'Rows: ' || CAST((SELECT count(*) FROM e) AS VARCHAR)
UNION ALL SELECT 7, 'Columns: 8'
UNION ALL SELECT 8, 'Duplicate rows by user_id: ' || CAST({dup} AS VARCHAR)
UNION ALL SELECT 9, 'Numeric columns checked for outliers: 3'
UNION ALL SELECT 10, 'Categorical columns checked for cardinality: 4'"""


@query("qc_recommendations", "O-33", _qc_sql())
def q_qc_recommendations(spark, sf):
    return qc_recommendations(qc_events(spark, sf), "user_id")


BIAS_SRC_SQL = f"""(SELECT o.o_orderstatus, v.segment, CAST(v.cohort AS VARCHAR) AS cohort,
  CASE WHEN v.x / 100 >= 0 AND v.x / 100 < 40 THEN '0-39' WHEN v.x / 100 >= 40 AND v.x / 100 < 50 THEN '40-49'
       WHEN v.x / 100 >= 50 AND v.x / 100 < 60 THEN '50-59' WHEN v.x / 100 >= 60 AND v.x / 100 < 70 THEN '60-69'
       WHEN v.x / 100 >= 70 AND v.x / 100 < 80 THEN '70-79' WHEN v.x / 100 >= 80 AND v.x / 100 < 100 THEN '80+' END
    AS age_group
FROM orders o JOIN {COHORT_VIEW_SQL} v ON o.o_custkey = v.id)"""


def _bias_sql() -> str:
    from .profiles import _chi2_sql

    parts = [
        f"SELECT 'o_orderstatus' AS target, '{b}' AS bias_column, statistic, dof FROM ({_chi2_sql(BIAS_SRC_SQL, 'o_orderstatus', b)})"
        for b in ["segment", "cohort", "age_group"]
    ]
    return "\nUNION ALL ".join(parts)


@query("bias_profile", "O-47", _bias_sql())
def q_bias_profile(spark, sf):
    base = cohorts_of(spark, sf).withColumn("age_group", age_group(F.col("x") / 100))
    o = load(spark, sf, "orders").select("o_custkey", "o_orderstatus")
    j = o.join(base.withColumnRenamed("id", "o_custkey"), "o_custkey")
    out = bias_profile(j, ["o_orderstatus"], ["segment", "cohort", "age_group"], with_p=False)
    return out.select("target", "bias_column", r6("statistic").alias("statistic"), "dof")


@query("bias_profile_pvalues", "O-47")
def q_bias_profile_p(spark, sf):
    base = cohorts_of(spark, sf).withColumn("age_group", age_group(F.col("x") / 100))
    o = load(spark, sf, "orders").select("o_custkey", "o_orderstatus")
    j = o.join(base.withColumnRenamed("id", "o_custkey"), "o_custkey")
    return bias_profile(j, ["o_orderstatus"], ["segment", "cohort", "age_group"])


@query(
    "expression_matrix",
    "O-107",
    f"""WITH l AS {EMB_LONG_SQL},
top AS (SELECT feature FROM (SELECT feature, row_number() OVER (ORDER BY var_samp(value) DESC NULLS LAST, feature) AS r
  FROM l GROUP BY feature) WHERE r <= 50),
e AS (SELECT list_sort(list_distinct(quantile_cont(CAST(label AS DOUBLE), [0.0, 0.25, 0.5, 0.75, 1.0]))) AS edges
  FROM embeddings WHERE label IS NOT NULL)
SELECT l.feature, l.vec_id AS sample, {s6('l.value')} AS value, l.label,
  CAST(greatest(len(list_filter(e.edges, lambda t: t < l.label)) - 1, 0) AS BIGINT) AS label_binned
FROM l JOIN top USING (feature), e""",
)
def q_expression_matrix(spark, sf):
    from ..plans.eda import expression_matrix

    out = expression_matrix(embeddings_long(spark, sf), "vec_id", "label", k=50)
    return out.select("feature", "sample", r6("value").alias("value"), "label", "label_binned")
