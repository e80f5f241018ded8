"""Bindings: clipping, rare grouping, imputing, encoding, scaler choice and transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import kolmogorov_p_sql, normal_cdf_sql, r6
from ..operators import encode as E
from ..operators import scale as SC
from ..operators.profile import melt
from ..session import load
from .profiles import embeddings_long, lineitem_with_id
from .registry import query
from .sqlgen import EMB_LONG_SQL, LINEITEM_ID, long_sql
from .sqlgen import r6 as s6


@query(
    "iqr_clip",
    "O-69",
    f"""WITH b AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3
  FROM lineitem WHERE l_linestatus = 'F')
SELECT l_orderkey, l_linenumber, {s6('''CASE WHEN l_extendedprice < q1 - 1.5 * (q3 - q1) THEN q1
  WHEN l_extendedprice > q3 + 1.5 * (q3 - q1) THEN q3 ELSE l_extendedprice END''')} AS l_extendedprice
FROM lineitem, b""",
)
def q_iqr_clip(spark, sf):
    li = lineitem_with_id(spark, sf)
    long = melt(li, ["row_id", "l_orderkey", "l_linenumber", "l_linestatus"], ["l_extendedprice"])
    bounds = SC.fit_iqr_bounds(long.where(F.col("l_linestatus") == "F"))
    out = SC.iqr_clip_long(long, bounds)
    return out.select("l_orderkey", "l_linenumber", r6("value").alias("l_extendedprice"))


def _rare_sql(mult: float) -> str:
    return f"""WITH f AS (SELECT p_brand, count(*) AS n FROM part WHERE p_size <= 40 GROUP BY p_brand),
t AS (SELECT quantile_cont(n, 0.5) - {mult} * coalesce(var_samp(n), 0) AS thr FROM f),
r AS (SELECT p_brand FROM f, t WHERE n < thr)
SELECT p_partkey, p_brand, CASE WHEN p_brand IN (SELECT p_brand FROM r) THEN 'rare' ELSE p_brand END AS p_brand_grouped
FROM part"""


@query("group_rare", "O-70", _rare_sql(2.0))
def q_group_rare(spark, sf):
    part = load(spark, sf, "part")
    rare = E.fit_rare(part.where(F.col("p_size") <= 40), "p_brand", 2.0)
    return E.group_rare(part.select("p_partkey", "p_brand"), "p_brand", rare)


@query("group_rare_low_threshold", "O-70", _rare_sql(0.1))
def q_group_rare_low(spark, sf):
    part = load(spark, sf, "part")
    rare = E.fit_rare(part.where(F.col("p_size") <= 40), "p_brand", 0.1)
    return E.group_rare(part.select("p_partkey", "p_brand"), "p_brand", rare)


_ORD_NULL_SQL = """(SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS price, o_custkey FROM orders)"""


@query(
    "impute",
    "O-71",
    f"""WITH o AS {_ORD_NULL_SQL},
m AS (SELECT quantile_cont(price, 0.5) AS mp, quantile_cont(CAST(o_custkey AS DOUBLE), 0.5) AS mc FROM o
      WHERE o_orderkey % 2 = 0)
SELECT o_orderkey, coalesce(status, 'unknown') AS status, {s6('coalesce(price, mp)')} AS price,
  {s6('coalesce(CAST(o_custkey AS DOUBLE), mc)')} AS o_custkey FROM o, m""",
)
def q_impute(spark, sf):
    o = load(spark, sf, "orders").select(
        "o_orderkey",
        F.expr("nullif(o_orderstatus, 'P')").alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price"),
        "o_custkey",
    )
    # train = even order keys (a fixed split of the whole table); medians fitted there, applied to all rows
    train = o.where(F.col("o_orderkey") % 2 == 0)
    med = {r["column"]: r["median"] for r in E.fit_medians(train, ["price", "o_custkey"], "o_orderkey").collect()}
    out = E.impute(o, med, ["status"])
    return out.select("o_orderkey", "status", r6("price").alias("price"), r6("o_custkey").alias("o_custkey"))


@query(
    "one_hot",
    "O-72",
    """SELECT p_partkey, p_size, """
    + ", ".join(
        f"CAST(coalesce(p_type = '{v}', false) AS DOUBLE) AS p_type_{v}"
        for v in ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    )
    + " FROM (SELECT p_partkey, p_size, p_type FROM part)",
)
def q_one_hot(spark, sf):
    part = load(spark, sf, "part").select("p_partkey", "p_size", "p_type")
    cats = E.fit_categories(part.where(F.col("p_size") <= 40), ["p_type"])
    return E.one_hot(part, cats)


@query(
    "get_dummies",
    "O-73",
    """SELECT p_partkey, """
    + ", ".join(
        f"coalesce(nullif(p_type, 'PROMO') = '{v}', false) AS p_type_{v}"
        for v in ["LARGE", "MEDIUM", "SMALL", "STANDARD"]
    )
    + " FROM part",
)
def q_get_dummies(spark, sf):
    part = load(spark, sf, "part").select("p_partkey", F.expr("nullif(p_type, 'PROMO')").alias("p_type"))
    cats = E.fit_categories(part, ["p_type"])
    return E.get_dummies(part, cats, drop_first=True)


SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _scaler_sql() -> str:
    z = "((value - m) / s)"
    cdf = normal_cdf_sql(z)
    return f"""WITH long AS {long_sql('lineitem', SCALE_COLS, ids=[LINEITEM_ID + ' AS rid'])},
v AS (SELECT * FROM long WHERE value IS NOT NULL AND NOT isnan(value)),
st AS (SELECT column, count(*) AS n, avg(value) AS m, stddev_samp(value) AS s, min(value) AS mn, max(value) AS mx,
  avg(CASE WHEN value = 0 THEN 1.0 ELSE 0.0 END) AS zr, kurtosis(value) AS k FROM v GROUP BY column),
r AS (SELECT v.column, v.value, row_number() OVER (PARTITION BY v.column ORDER BY v.value, v.rid) AS i, st.n, st.m, st.s
      FROM v JOIN st USING (column) WHERE st.s > 0),
d AS (SELECT column, max(greatest(i / CAST(n AS DOUBLE) - {cdf}, {cdf} - (i - 1) / CAST(n AS DOUBLE))) AS ks FROM r
      GROUP BY column),
x AS (SELECT st.*, d.ks, {kolmogorov_p_sql('d.ks', 'st.n')} AS p FROM st LEFT JOIN d USING (column))
SELECT column, CASE WHEN n = 0 THEN 'NoScaling' WHEN s IS NULL OR s = 0 THEN 'NoScaling'
  WHEN zr >= 0.5 AND mn >= 0 THEN 'Log1pTransform' WHEN mn >= 0 AND mx <= 1 THEN 'MinMaxScaler'
  WHEN p >= 0.05 AND ks <= 0.08 AND abs(k) <= 1 THEN 'StandardScaler'
  WHEN p < 0.05 OR ks > 0.08 OR abs(k) > 3 THEN 'RobustScaler' ELSE 'StandardScaler' END AS decision,
  {s6('ks')} AS ks_stat, {s6('k')} AS kurtosis FROM x"""


@query("choose_scaler", "O-83", _scaler_sql())
def q_choose_scaler(spark, sf):
    long = melt(lineitem_with_id(spark, sf), ["row_id"], SCALE_COLS)
    out = SC.choose_scaler(long)
    return out.select("column", "decision", r6("ks_stat").alias("ks_stat"), r6("kurtosis").alias("kurtosis"))


def _one_col(spark, sf, c):
    return melt(lineitem_with_id(spark, sf), ["row_id", "l_orderkey", "l_linenumber"], [c])


def _apply_fixed(long, decision):
    st = SC.fit_transform(long, decision)
    return SC.apply_params_long(long, st).select("l_orderkey", "l_linenumber", r6("value").alias("value"))


@query("log1p_transform", "O-84", f"SELECT l_orderkey, l_linenumber, {s6('ln(1 + l_quantity)')} AS value FROM lineitem")
def q_log1p(spark, sf):
    return _apply_fixed(_one_col(spark, sf, "l_quantity"), SC.LOG1P)


@query(
    "minmax_transform",
    "O-85",
    f"""SELECT l_orderkey, l_linenumber, {s6('CASE WHEN mx > mn THEN (l_discount - mn) / (mx - mn) ELSE l_discount END')}
  AS value FROM lineitem, (SELECT min(l_discount) AS mn, max(l_discount) AS mx FROM lineitem) b""",
)
def q_minmax(spark, sf):
    return _apply_fixed(_one_col(spark, sf, "l_discount"), SC.MINMAX)


@query(
    "standard_transform",
    "O-86",
    f"""SELECT l_orderkey, l_linenumber, {s6('CASE WHEN s > 0 THEN (l_extendedprice - m) / s ELSE l_extendedprice END')}
  AS value FROM lineitem, (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM lineitem) b""",
)
def q_standard(spark, sf):
    return _apply_fixed(_one_col(spark, sf, "l_extendedprice"), SC.STANDARD)


@query(
    "robust_transform",
    "O-87",
    f"""SELECT l_orderkey, l_linenumber,
  {s6('CASE WHEN q3 - q1 > 0 THEN (l_extendedprice - med) / (q3 - q1) ELSE l_extendedprice END')} AS value
FROM lineitem, (SELECT quantile_cont(l_extendedprice, 0.5) AS med, quantile_cont(l_extendedprice, 0.25) AS q1,
  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem) b""",
)
def q_robust(spark, sf):
    return _apply_fixed(_one_col(spark, sf, "l_extendedprice"), SC.ROBUST)


@query(
    "variance_select",
    "O-88",
    f"""WITH l AS (SELECT feature, value FROM {EMB_LONG_SQL} e
  UNION ALL SELECT CAST(-1 AS BIGINT) AS feature, 0.0 * label AS value FROM embeddings)
SELECT feature, {s6('var_pop(value)')} AS variance, coalesce(var_pop(value) > 0, false) AS selected
FROM l GROUP BY feature""",
)
def q_variance_select(spark, sf):
    long = embeddings_long(spark, sf)
    const = load(spark, sf, "embeddings").select(F.lit(-1).cast("long").alias("feature"), (F.col("label") * 0.0).alias("value"))
    both = long.select(F.col("feature").alias("column"), "value").unionByName(const.withColumnRenamed("feature", "column"))
    out = SC.variance_select(both)
    return out.select(F.col("column").alias("feature"), r6("variance").alias("variance"), "selected")
