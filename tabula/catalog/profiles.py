"""Bindings: profiles and statistics (O-26..O-46, O-50)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import kolmogorov_p_sql, normal_cdf_sql, r6
from ..operators import profile as P
from ..operators import stats as S
from ..session import load
from .registry import query
from .sqlgen import EMB_LONG_SQL, LINEITEM_ID, long_sql
from .sqlgen import r6 as s6

NUM4 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lineitem_with_id(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.withColumn("row_id", F.col("l_orderkey") * 16 + F.col("l_linenumber"))


def embeddings_long(spark, sf):
    """(vec_id, label, feature, value): one row per embedding dimension (posexplode)."""
    e = load(spark, sf, "embeddings")
    return e.select("vec_id", "label", F.posexplode("embedding").alias("feature", "value")).select(
        "vec_id", "label", F.col("feature").cast("long").alias("feature"), F.col("value").cast("double").alias("value")
    )


def rounded(df, cols):
    return df.select(*[r6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


@query(
    "duplicate_count",
    "O-26",
    """SELECT CAST(count(*) - count(DISTINCT user_id) - max(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) AS BIGINT)
         AS duplicates,
       count(*) - count(DISTINCT user_id) - max(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) > 0 AS has_duplicates
FROM events""",
)
def q_duplicate_count(spark, sf):
    return P.duplicate_count(load(spark, sf, "events"), "user_id")


@query(
    "dedupe_first",
    "O-27",
    """SELECT event_id, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) WHERE rn = 1""",
)
def q_dedupe_first(spark, sf):
    e = load(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props")
    return P.dedupe_first(e, "user_id", "event_id")


ORDERS_WITH_NULLS = """(SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS o_totalprice,
  o_orderdate, nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders)"""


def orders_with_nulls(spark, sf):
    o = load(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        "o_custkey",
        F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.expr("nullif(o_orderpriority, '5-LOW')").alias("o_orderpriority"),
    )


_NP_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    "null_profile",
    "O-28",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS null_count, "
        f"count(*) - count({c}) > 0 AS has_nulls FROM {ORDERS_WITH_NULLS} o"
        for c in _NP_COLS
    ),
)
def q_null_profile(spark, sf):
    return P.null_profile(orders_with_nulls(spark, sf))


@query(
    "iqr_profile",
    "O-29",
    f"""WITH long AS {long_sql('lineitem', NUM4)},
q AS (SELECT column, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM long GROUP BY column),
b AS (SELECT column, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT b.column, {s6('b.q1')} AS q1, {s6('b.q3')} AS q3, {s6('b.iqr')} AS iqr, {s6('b.lower')} AS lower,
       {s6('b.upper')} AS upper,
       CAST(sum(CASE WHEN l.value < b.lower OR l.value > b.upper THEN 1 ELSE 0 END) AS BIGINT) AS outliers,
       sum(CASE WHEN l.value < b.lower OR l.value > b.upper THEN 1 ELSE 0 END) > 0 AS has_outliers
FROM long l JOIN b USING (column) GROUP BY b.column, b.q1, b.q3, b.iqr, b.lower, b.upper""",
)
def q_iqr_profile(spark, sf):
    out = P.iqr_profile(lineitem_with_id(spark, sf), "row_id", NUM4)
    return rounded(out, ["q1", "q3", "iqr", "lower", "upper"])


@query(
    "cardinality_profile",
    "O-30",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column, CAST(count(DISTINCT lower(trim({c}))) AS BIGINT) AS cardinality, "
        f"count(DISTINCT lower(trim({c}))) > 20 AS high_cardinality FROM part"
        for c in ["p_name", "p_brand", "p_type"]
    ),
)
def q_cardinality_profile(spark, sf):
    return P.cardinality_profile(load(spark, sf, "part"), ["p_name", "p_brand", "p_type"])


_BC_TOKENS = ("positive", "+", "yes", "1", "o")


@query(
    "boolean_candidates",
    "O-31",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column, CAST(count(DISTINCT lower(trim({c}))) AS BIGINT) AS cardinality, "
        f"count(DISTINCT lower(trim({c}))) = 2 AND coalesce(bool_or(lower(trim({c})) IN "
        f"('positive', '+', 'yes', '1', 'o')), false) AS is_boolean_candidate FROM lineitem"
        for c in ["l_returnflag", "l_linestatus"]
    ),
)
def q_boolean_candidates(spark, sf):
    return P.boolean_candidates(load(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], _BC_TOKENS)


_TF_SQL = """(SELECT CASE o_orderstatus WHEN 'F' THEN ' True' WHEN 'O' THEN 'false ' END AS tf,
  o_orderstatus AS st FROM orders)"""


@query(
    "true_false_candidates",
    "O-32",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column, count({c}) > 0 AND coalesce(bool_and(lower(trim({c})) IN ('true', 'false')), true)"
        f" AS is_true_false FROM {_TF_SQL} t"
        for c in ["tf", "st"]
    ),
)
def q_true_false_candidates(spark, sf):
    o = load(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "F", " True").when(F.col("o_orderstatus") == "O", "false ").alias("tf"),
        F.col("o_orderstatus").alias("st"),
    )
    return P.true_false_candidates(o, ["tf", "st"])


@query(
    "value_counts",
    "O-34",
    "SELECT lower(trim(p_type)) AS value, CAST(count(*) AS BIGINT) AS count FROM part GROUP BY 1",
)
def q_value_counts(spark, sf):
    return P.value_counts(load(spark, sf, "part"), "p_type")


def _freq_threshold_sql(mult: float) -> str:
    return f"""WITH f AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand)
SELECT {s6('quantile_cont(n, 0.5)')} AS median_freq, {s6('coalesce(var_samp(n), 0)')} AS var_freq,
       {s6(f'quantile_cont(n, 0.5) - {mult} * coalesce(var_samp(n), 0)')} AS threshold FROM f"""


@query("frequency_threshold", "O-35", _freq_threshold_sql(2.0))
def q_frequency_threshold(spark, sf):
    freq = P.value_counts(load(spark, sf, "part"), "p_brand", normalize=False)
    return rounded(P.frequency_threshold(freq, "count", 2.0), ["median_freq", "var_freq", "threshold"])


@query("frequency_threshold_low", "O-35", _freq_threshold_sql(0.1))
def q_frequency_threshold_low(spark, sf):
    freq = P.value_counts(load(spark, sf, "part"), "p_brand", normalize=False)
    return rounded(P.frequency_threshold(freq, "count", 0.1), ["median_freq", "var_freq", "threshold"])


@query(
    "crosstab",
    "O-36",
    """WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders
  WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY 1, 2)
SELECT a.o_orderstatus, b.o_orderpriority, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT DISTINCT o_orderstatus FROM c) a CROSS JOIN (SELECT DISTINCT o_orderpriority FROM c) b
LEFT JOIN c USING (o_orderstatus, o_orderpriority)""",
)
def q_crosstab(spark, sf):
    return S.crosstab_long(load(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


def _chi2_sql(src: str, a: str, b: str) -> str:
    return f"""WITH c AS (SELECT {a} AS a, {b} AS b, count(*) AS n FROM {src} WHERE {a} IS NOT NULL AND {b} IS NOT NULL
  GROUP BY 1, 2),
g AS (SELECT x.a, y.b, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT a FROM c) x CROSS JOIN (SELECT DISTINCT b FROM c) y
  LEFT JOIN c USING (a, b)),
m AS (SELECT a, b, n, sum(n) OVER (PARTITION BY a) AS r, sum(n) OVER (PARTITION BY b) AS cc, sum(n) OVER () AS t,
  (SELECT (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) FROM g) AS dof FROM g),
e AS (SELECT n, r * cc / t AS e, dof FROM m)
SELECT {s6('sum(power(abs(n - e) - CASE WHEN dof = 1 THEN least(0.5, abs(n - e)) ELSE 0 END, 2) / e)')} AS statistic,
       CAST(max(dof) AS BIGINT) AS dof FROM e"""


@query("chi2_test", "O-37", _chi2_sql("orders", "o_orderstatus", "o_orderpriority"))
def q_chi2_test(spark, sf):
    ct = S.crosstab_counts(load(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")
    return rounded(S.chi2_statistic(ct, "o_orderstatus", "o_orderpriority"), ["statistic"])


@query("chi2_test_yates", "O-37", _chi2_sql("labels", "quality", "toxic"))
def q_chi2_test_yates(spark, sf):
    ct = S.crosstab_counts(load(spark, sf, "labels"), "quality", "toxic")
    return rounded(S.chi2_statistic(ct, "quality", "toxic"), ["statistic"])


@query("chi2_pvalue", "O-37")
def q_chi2_pvalue(spark, sf):
    ct = S.crosstab_counts(load(spark, sf, "labels"), "quality", "toxic")
    return S.chi2_test(ct, "quality", "toxic")


def _moments_sql() -> str:
    return f"""SELECT column, CAST(count(*) AS BIGINT) AS n, {s6('avg(value)')} AS mean, {s6('stddev_samp(value)')} AS std,
  {s6('min(value)')} AS min, {s6('max(value)')} AS max, {s6('avg(CASE WHEN value = 0 THEN 1.0 ELSE 0.0 END)')} AS zero_ratio,
  {s6('kurtosis(value)')} AS kurtosis
FROM {long_sql('lineitem', NUM4)} l WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY column"""


@query("moments_profile", "O-38", _moments_sql())
def q_moments_profile(spark, sf):
    out = P.moments_profile(load(spark, sf, "lineitem"), NUM4)
    return rounded(out, ["mean", "std", "min", "max", "zero_ratio", "kurtosis"])


def _ks_sql(cols) -> str:
    z = "((value - m) / s)"
    cdf = normal_cdf_sql(z)
    return f"""WITH long AS {long_sql('lineitem', cols, ids=[LINEITEM_ID + ' AS rid'])},
st AS (SELECT column, count(*) AS n, avg(value) AS m, stddev_samp(value) AS s FROM long WHERE value IS NOT NULL GROUP BY column),
r AS (SELECT l.column, l.value, row_number() OVER (PARTITION BY l.column ORDER BY l.value, l.rid) AS i, st.n, st.m, st.s
      FROM long l JOIN st USING (column) WHERE l.value IS NOT NULL),
g AS (SELECT column, n, greatest(i / CAST(n AS DOUBLE) - {cdf}, {cdf} - (i - 1) / CAST(n AS DOUBLE)) AS gap FROM r),
d AS (SELECT column, max(gap) AS ks_stat, CAST(max(n) AS BIGINT) AS n FROM g GROUP BY column)
SELECT column, {s6('ks_stat')} AS ks_stat, n, {s6(kolmogorov_p_sql('ks_stat', 'n'))} AS ks_p FROM d"""


@query("ks_normal", "O-39", _ks_sql(["l_quantity", "l_extendedprice"]))
def q_ks_normal(spark, sf):
    out = S.ks_normal(lineitem_with_id(spark, sf), "row_id", ["l_quantity", "l_extendedprice"])
    return rounded(out, ["ks_stat", "ks_p"]).select("column", "ks_stat", F.col("n").cast("long"), "ks_p")


def _corr_sql() -> str:
    parts = []
    for a in NUM4:
        for b in NUM4:
            val = "max(1.0)" if a == b else f"corr({a}, {b})"
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {s6(val)} AS corr FROM lineitem")
    return "\nUNION ALL ".join(parts)


@query("correlation_matrix", "O-40", _corr_sql())
def q_correlation_matrix(spark, sf):
    return rounded(S.correlation_long(load(spark, sf, "lineitem"), NUM4), ["corr"])


@query(
    "target_correlation_rank",
    "O-41",
    f"""WITH c AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, corr({f}, l_extendedprice) AS corr FROM lineitem"
                                     for f in ['l_quantity', 'l_discount', 'l_tax'])})
SELECT feature, {s6('corr')} AS corr, CAST(row_number() OVER (ORDER BY corr DESC, feature) AS BIGINT) AS rank FROM c""",
)
def q_target_correlation_rank(spark, sf):
    out = S.target_correlation_rank(load(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    return rounded(out, ["corr"])


@query(
    "top_variance_features",
    "O-42",
    f"""WITH v AS (SELECT feature, var_samp(value) AS variance FROM {EMB_LONG_SQL} e GROUP BY feature),
r AS (SELECT feature, variance, row_number() OVER (ORDER BY variance DESC NULLS LAST, feature) AS rank FROM v)
SELECT feature, {s6('variance')} AS variance, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= 50""",
)
def q_top_variance_features(spark, sf):
    out = S.top_variance_features(embeddings_long(spark, sf), 50)
    return out.select("feature", r6(F.col("variance") * 1.0).alias("variance"), "rank")


def _qcut_sql(q: int) -> str:
    probs = ", ".join(str(i / q) for i in range(q + 1))
    return f"""WITH long AS {long_sql('lineitem', ['l_quantity', 'l_discount'], ids=['l_orderkey', 'l_linenumber'])},
e AS (SELECT column, list_sort(list_distinct(quantile_cont(value, [{probs}]))) AS edges FROM long
      WHERE value IS NOT NULL GROUP BY column)
SELECT l.l_orderkey, l.l_linenumber, l.column,
       CAST(greatest(len(list_filter(e.edges, lambda x: x < l.value)) - 1, 0) AS BIGINT) AS bin
FROM long l JOIN e USING (column)"""


@query("qcut_values", "O-50", _qcut_sql(4))
def q_qcut_values(spark, sf):
    li = load(spark, sf, "lineitem").withColumn("row_id", F.col("l_orderkey") * 16 + F.col("l_linenumber"))
    out = S.qcut_values(li, "row_id", ["l_quantity", "l_discount"], 4, keep=["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", "column", "bin")


def _mi_sql() -> str:
    probs = ", ".join(str(i / 10) for i in range(11))
    return f"""WITH long AS {EMB_LONG_SQL},
e AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [{probs}]))) AS edges FROM long GROUP BY feature),
x AS (SELECT l.feature, greatest(len(list_filter(e.edges, lambda t: t < l.value)) - 1, 0) AS xb,
             CAST(l.label AS VARCHAR) AS y FROM long l JOIN e USING (feature) WHERE l.label IS NOT NULL),
j AS (SELECT feature, xb, y, count(*) AS nxy FROM x GROUP BY ALL),
m AS (SELECT feature, xb, y, nxy, sum(nxy) OVER (PARTITION BY feature, xb) AS nx,
             sum(nxy) OVER (PARTITION BY feature, y) AS ny, sum(nxy) OVER (PARTITION BY feature) AS n FROM j),
mi AS (SELECT feature, sum((nxy / n) * ln((nxy * n) / (nx * ny))) AS mi FROM m GROUP BY feature)
SELECT feature, {s6('mi')} AS mi, CAST(row_number() OVER (ORDER BY mi DESC, feature) AS BIGINT) AS rank FROM mi"""


@query("mutual_information", "O-43", _mi_sql())
def q_mutual_information(spark, sf):
    out = S.mutual_information(embeddings_long(spark, sf), "label", "vec_id", bins=10)
    return rounded(out, ["mi"])


@query(
    "histogram",
    "O-44",
    f"""WITH long AS {long_sql('lineitem', NUM4)},
r AS (SELECT column, min(value) AS lo, max(value) AS hi FROM long GROUP BY column),
b AS (SELECT l.column, r.lo, r.hi,
  CAST(CASE WHEN r.hi = r.lo THEN 0 ELSE least(floor((l.value - r.lo) / ((r.hi - r.lo) / 10)), 9) END AS BIGINT) AS bin
  FROM long l JOIN r USING (column) WHERE l.value IS NOT NULL)
SELECT column, bin, {s6('max(lo) + bin * (max(hi) - max(lo)) / 10')} AS bin_start, CAST(count(*) AS BIGINT) AS count
FROM b GROUP BY column, bin""",
)
def q_histogram(spark, sf):
    long = P.melt(load(spark, sf, "lineitem"), [], NUM4)
    return rounded(S.histogram(long, 10), ["bin_start"])


@query(
    "kde_curve",
    "O-44",
    f"""WITH long AS {long_sql('lineitem', ['l_quantity', 'l_discount'])},
st AS (SELECT column, count(*) AS n, stddev_samp(value) * pow(count(*), -0.2) AS h, min(value) AS lo, max(value) AS hi
       FROM long WHERE value IS NOT NULL GROUP BY column),
g AS (SELECT column, n, h, gi, lo + (hi - lo) * gi / 49 AS x FROM st, range(50) t(gi))
SELECT g.column, CAST(g.gi AS INTEGER) AS gi, {s6('g.x')} AS x,
       {s6('sum(exp(-0.5 * ((g.x - l.value) / g.h) * ((g.x - l.value) / g.h)) / sqrt(2 * pi())) / (g.n * g.h)')} AS density
FROM g JOIN long l ON l.column = g.column AND l.value IS NOT NULL GROUP BY g.column, g.gi, g.x, g.n, g.h""",
)
def q_kde_curve(spark, sf):
    long = P.melt(load(spark, sf, "lineitem"), [], ["l_quantity", "l_discount"])
    return rounded(S.kde_curve(long, 50), ["x", "density"])


@query(
    "boxplot_stats",
    "O-45",
    f"""WITH long AS {long_sql('lineitem', NUM4)},
q AS (SELECT column, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM long GROUP BY column),
f AS (SELECT column, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.column, {s6('f.q1')} AS q1, {s6('f.median')} AS median, {s6('f.q3')} AS q3,
  {s6('min(CASE WHEN l.value BETWEEN f.lo AND f.hi THEN l.value END)')} AS whisker_low,
  {s6('max(CASE WHEN l.value BETWEEN f.lo AND f.hi THEN l.value END)')} AS whisker_high,
  CAST(sum(CASE WHEN l.value BETWEEN f.lo AND f.hi THEN 0 ELSE 1 END) AS BIGINT) AS fliers
FROM long l JOIN f USING (column) GROUP BY f.column, f.q1, f.median, f.q3""",
)
def q_boxplot_stats(spark, sf):
    out = P.boxplot_stats(lineitem_with_id(spark, sf), "row_id", NUM4)
    return rounded(out, ["q1", "median", "q3", "whisker_low", "whisker_high"])


@query(
    "group_mean_argmax",
    "O-46",
    f"""WITH m AS (SELECT event_type, avg(value) AS mean_metric FROM events GROUP BY event_type)
SELECT event_type, {s6('mean_metric')} AS mean_metric,
       event_type = (SELECT arg_max(event_type, mean_metric) FROM m) AS is_best FROM m""",
)
def q_group_mean_argmax(spark, sf):
    return rounded(S.group_mean_argmax(load(spark, sf, "events"), "event_type", "value"), ["mean_metric"])


@query(
    "correlation_matrix_wide",
    "O-40",
    f"""WITH l AS (SELECT vec_id, 'e' || CAST(feature AS VARCHAR) AS f, value FROM {EMB_LONG_SQL} e
  UNION ALL SELECT vec_id, 'label' AS f, CAST(label AS DOUBLE) AS value FROM embeddings)
SELECT a.f AS col_a, b.f AS col_b,
  {s6("CASE WHEN a.f = b.f THEN 1.0 ELSE corr(a.value, b.value) END")} AS corr
FROM l a JOIN l b USING (vec_id) GROUP BY a.f, b.f""",
)
def q_correlation_matrix_wide(spark, sf):
    """65 columns (64 embedding dimensions + label)."""
    e = load(spark, sf, "embeddings")
    cols = [f"e{i}" for i in range(64)] + ["label"]
    wide = e.select(*[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)],
                    F.col("label").cast("double").alias("label"))
    return rounded(S.correlation_long(wide, cols), ["corr"])


@query(
    "correlation_matrix_nulls",
    "O-40",
    f"""WITH l AS (SELECT vec_id, feature, 'e' || CAST(feature AS VARCHAR) AS f,
    CASE WHEN (vec_id + feature) % 7 = 0 OR vec_id % 64 = feature THEN NULL ELSE value END AS value FROM {EMB_LONG_SQL} e
  UNION ALL SELECT vec_id, 64, 'label', CASE WHEN vec_id % 3 = 0 THEN NULL ELSE CAST(label AS DOUBLE) END FROM embeddings)
SELECT a.f AS col_a, b.f AS col_b,
  {s6("CASE WHEN a.f = b.f THEN 1.0 ELSE corr(a.value, b.value) END")} AS corr
FROM l a JOIN l b USING (vec_id) GROUP BY a.f, b.f""",
)
def q_correlation_matrix_nulls(spark, sf):
    """65 columns with NULLs in other rows of each: every pair over the rows that have both."""
    e = load(spark, sf, "embeddings")
    gone = [((F.col("vec_id") + i) % 7 == 0) | (F.col("vec_id") % 64 == i) for i in range(64)]
    wide = e.select(*[F.when(~gone[i], F.col("embedding")[i].cast("double")).alias(f"e{i}") for i in range(64)],
                    F.when(F.col("vec_id") % 3 != 0, F.col("label").cast("double")).alias("label"))
    return rounded(S.correlation_long(wide, wide.columns), ["corr"])
