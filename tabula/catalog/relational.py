"""Bindings: projections, filters, joins, sort/top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational as R
from ..operators.encode import fit_categories, one_hot
from ..operators.split import cohort_list
from ..session import load
from .core import COHORT_VIEW_SQL, cohorts_of
from .registry import query

LINEITEM_ATTRS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"]


@query(
    "project_complement",
    "O-08",
    "SELECT * EXCLUDE (l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus, l_shipdate) "
    "FROM lineitem",
)
def q_project_complement(spark, sf):
    return R.project_complement(load(spark, sf, "lineitem"), LINEITEM_ATTRS)


@query("project_by_type", "O-09", "SELECT p_partkey, p_size, p_retailprice FROM part")
def q_project_by_type(spark, sf):
    return R.project_by_type(load(spark, sf, "part"), "numeric")


@query("project_categorical", "O-09", "SELECT p_name, p_brand, p_type FROM part")
def q_project_categorical(spark, sf):
    return R.project_by_type(load(spark, sf, "part"), "categorical")


@query(
    "project_by_prefix",
    "O-10",
    """SELECT p_partkey, p_size,
  CAST(p_type = 'ECONOMY' AS DOUBLE) AS p_type_ECONOMY, CAST(p_type = 'LARGE' AS DOUBLE) AS p_type_LARGE,
  CAST(p_type = 'MEDIUM' AS DOUBLE) AS p_type_MEDIUM, CAST(p_type = 'PROMO' AS DOUBLE) AS p_type_PROMO,
  CAST(p_type = 'SMALL' AS DOUBLE) AS p_type_SMALL, CAST(p_type = 'STANDARD' AS DOUBLE) AS p_type_STANDARD
FROM part""",
)
def q_project_by_prefix(spark, sf):
    part = load(spark, sf, "part").select("p_partkey", "p_size", "p_type", "p_brand")
    enc = one_hot(part, fit_categories(part, ["p_type"]))
    # wanted: p_partkey (present), p_type (encoded → p_type_*), p_size (present), p_color (absent)
    return R.project_by_prefix(enc.drop("p_brand"), ["p_partkey", "p_type", "p_size", "p_color"])


@query("project_by_regex", "O-11", "SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount, l_tax FROM lineitem")
def q_project_by_regex(spark, sf):
    return R.project_by_regex(load(spark, sf, "lineitem"), r"l_.*(price|discount|tax)$", keep=["l_orderkey", "l_linenumber"])


@query("drop_if_exists", "O-12", "SELECT * EXCLUDE (o_orderdate) FROM orders")
def q_drop_if_exists(spark, sf):
    return R.drop_if_exists(load(spark, sf, "orders"), ["o_orderdate", "o_not_a_column"])


@query(
    "filter_ne_or_eq",
    "O-13",
    """SELECT o_orderkey, status, o_orderpriority FROM (
  SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, o_orderpriority FROM orders)
WHERE status IS DISTINCT FROM 'F' OR o_orderpriority = '1-URGENT'""",
)
def q_filter_ne_or_eq(spark, sf):
    o = load(spark, sf, "orders").select(
        "o_orderkey", F.expr("nullif(o_orderstatus, 'P')").alias("status"), "o_orderpriority"
    )
    return R.filter_ne_or_eq(o, "status", "F", "o_orderpriority", "1-URGENT")


@query("filter_eq", "O-14", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def q_filter_eq(spark, sf):
    return R.filter_eq(load(spark, sf, "orders"), "o_orderstatus", "F").select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "filter_column_fallback",
    "O-15",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'",
)
def q_filter_column_fallback(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")  # status column absent
    return R.filter_column_fallback(o, "o_orderstatus", "F", "o_orderpriority", "1-URGENT")


@query(
    "filter_column_primary",
    "O-15",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus IS DISTINCT FROM 'F' OR o_orderpriority = '1-URGENT'""",
)
def q_filter_column_primary(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return R.filter_column_fallback(o, "o_orderstatus", "F", "o_orderpriority", "1-URGENT")


@query(
    "filter_null_safe_metadata",
    "O-16",
    """SELECT event_id, flag, value FROM (
  SELECT event_id, CASE WHEN event_type = 'error' THEN 'TRUE' WHEN event_type = 'signup' THEN 'FALSE' END AS flag,
         CASE WHEN event_type <> 'view' THEN value END AS value FROM events)
WHERE flag IS DISTINCT FROM 'TRUE' AND value IS NOT NULL""",
)
def q_filter_null_safe_metadata(spark, sf):
    e = load(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "TRUE").when(F.col("event_type") == "signup", "FALSE").alias("flag"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
    )
    return R.filter_null_safe_metadata(e, "flag", "TRUE", ["value"])


@query("align_features", "O-17", "SELECT p_size, p_retailprice, p_partkey FROM part")
def q_align_features(spark, sf):
    return R.align_features(load(spark, sf, "part"), ["p_size", "p_retailprice", "p_weight", "p_partkey"])


@query(
    "align_features_strict",
    "O-17",
    "SELECT p_size, p_retailprice, CAST(0.0 AS DOUBLE) AS p_weight, p_partkey FROM part",
)
def q_align_features_strict(spark, sf):
    return R.align_features(load(spark, sf, "part"), ["p_size", "p_retailprice", "p_weight", "p_partkey"], strict=True)


@query(
    "set_membership",
    "O-18",
    """SELECT p_partkey, p_brand FROM part
WHERE p_brand IN (SELECT p_brand FROM part WHERE p_retailprice < 902)""",
)
def q_set_membership(spark, sf):
    part = load(spark, sf, "part")
    expensive = part.where(F.col("p_retailprice") < 902).select("p_brand")
    return R.set_membership(part.select("p_partkey", "p_brand"), "p_brand", expensive)


@query(
    "set_membership_tokens",
    "O-18",
    "SELECT p_partkey, p_type FROM part WHERE p_type IN ('PROMO', 'SMALL')",
)
def q_set_membership_tokens(spark, sf):
    return R.set_membership(load(spark, sf, "part").select("p_partkey", "p_type"), "p_type", ["PROMO", "SMALL"])


@query(
    "drop_rows_any_null",
    "O-19",
    """SELECT DISTINCT user_id, event_type, metric FROM (
  SELECT user_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS metric FROM events)
WHERE user_id IS NOT NULL AND event_type IS NOT NULL AND metric IS NOT NULL""",
)
def q_drop_rows_any_null(spark, sf):
    e = load(spark, sf, "events").select(
        "event_id", "user_id", "event_type", F.when(F.col("event_type") != "error", F.col("value")).alias("metric")
    )
    return R.clean_rows(e, drop=["event_id"])


@query(
    "align_by_id",
    "O-20",
    """SELECT o.o_orderkey, o.o_custkey, c.c_acctbal, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""",
)
def q_align_by_id(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_mktsegment")
    return R.align_by_id(o, c, "o_custkey")


@query(
    "unseen_labels",
    "O-24",
    f"""WITH v AS (SELECT DISTINCT CAST(cohort AS VARCHAR) AS c, CAST(n.n_nationkey AS VARCHAR) AS label
  FROM {COHORT_VIEW_SQL} x JOIN customer cu ON cu.c_custkey = x.id JOIN nation n ON cu.c_nationkey = n.n_nationkey),
folds AS (SELECT DISTINCT c AS fold FROM v WHERE c IS NOT NULL)
SELECT t.c AS fold, t.label FROM v t
WHERE t.c IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM v s WHERE s.label IS NOT DISTINCT FROM t.label AND s.c IS DISTINCT FROM t.c)""",
)
def q_unseen_labels(spark, sf):
    cust = load(spark, sf, "customer")
    base = cohorts_of(spark, sf).join(cust.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("label")), "id")
    return R.unseen_labels(base, "label", "cohort", cohort_list(base, "cohort"))


@query(
    "top_k",
    "O-57",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def q_top_k(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return R.top_k(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


@query(
    "set_difference",
    "O-59",
    "SELECT c_custkey AS custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 400000",
)
def q_set_difference(spark, sf):
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"))
    o = load(spark, sf, "orders").where(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("custkey"))
    return R.set_difference(c, o)


@query(
    "set_intersection",
    "O-59",
    "SELECT c_nationkey AS nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier",
)
def q_set_intersection(spark, sf):
    c = load(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"))
    s = load(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return R.set_intersection(c, s)


@query(
    "union_distinct",
    "O-59",
    "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier",
)
def q_union_distinct(spark, sf):
    c = load(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"))
    s = load(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return R.union_distinct(c, s)


@query(
    "is_subset",
    "O-59",
    """SELECT NOT EXISTS (SELECT s_nationkey FROM supplier EXCEPT SELECT n_nationkey FROM nation) AS is_subset""",
)
def q_is_subset(spark, sf):
    s = load(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"))
    n = load(spark, sf, "nation").select(F.col("n_nationkey").alias("k"))
    return R.is_subset(s, n)


@query(
    "union_folds",
    "O-60",
    f"""SELECT CAST(cohort AS VARCHAR) AS fold, CAST(count(*) AS BIGINT) AS n, round(avg(x), 6) + 0.0 AS mean_x
FROM {COHORT_VIEW_SQL} v WHERE cohort IS NOT NULL GROUP BY cohort""",
)
def q_union_folds(spark, sf):
    base = cohorts_of(spark, sf)
    folds = cohort_list(base, "cohort")
    per = [
        base.where(F.col("cohort") == c).agg(
            F.count(F.lit(1)).cast("long").alias("n"), (F.round(F.avg("x"), 6) + 0.0).alias("mean_x")
        )
        for c in folds
    ]
    return R.union_folds(per, "fold", folds).select("fold", "n", "mean_x")
