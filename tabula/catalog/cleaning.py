"""Bindings: scalar cleaning functions and row-level transforms (O-61..O-82, O-108)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import numeric as N
from ..functions import text as T
from ..operators import encode as E
from ..operators.encode import coerce_numeric, numeric_feature_frame
from ..session import load
from .profiles import embeddings_long
from .registry import query
from .sqlgen import EMB_LONG_SQL
from .sqlgen import r6 as s6


@query("normalize_text", "O-61", "SELECT p_partkey, lower(trim(p_name)) AS name_norm FROM part")
def q_normalize_text(spark, sf):
    return load(spark, sf, "part").select("p_partkey", T.normalize_text("p_name").alias("name_norm"))


@query(
    "cut_bins",
    "O-62",
    """SELECT p_partkey, CASE WHEN p_size >= 0 AND p_size < 10 THEN '0-9' WHEN p_size >= 10 AND p_size < 20 THEN '10-19'
  WHEN p_size >= 20 AND p_size < 30 THEN '20-29' WHEN p_size >= 30 AND p_size < 40 THEN '30-39'
  WHEN p_size >= 40 AND p_size < 50 THEN '40-49' END AS size_bin FROM part""",
)
def q_cut_bins(spark, sf):
    edges, labels = [0, 10, 20, 30, 40, 50], ["0-9", "10-19", "20-29", "30-39", "40-49"]
    return load(spark, sf, "part").select("p_partkey", N.cut_bins("p_size", edges, labels).alias("size_bin"))


@query(
    "token_boolean",
    "O-63",
    """SELECT l_orderkey, l_linenumber, CASE WHEN lower(trim(s)) IS NULL THEN NULL
  ELSE lower(trim(s)) IN ('positive', '+', 'yes', '1', 'o') END AS flag
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_linestatus END AS s FROM lineitem)""",
)
def q_token_boolean(spark, sf):
    li = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") != "N", F.col("l_linestatus")).alias("s")
    )
    return li.select("l_orderkey", "l_linenumber", T.token_boolean("s", ("positive", "+", "yes", "1", "o")).alias("flag"))


@query(
    "target_boolean",
    "O-64",
    """SELECT o_orderkey, coalesce(lower(trim(t)) IN ('positive', '+', 'yes', '1'), false) AS target
FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN ' Yes' WHEN 'O' THEN '1.0' END AS t FROM orders)""",
)
def q_target_boolean(spark, sf):
    o = load(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", " Yes").when(F.col("o_orderstatus") == "O", "1.0").alias("t")
    )
    return o.select("o_orderkey", T.target_boolean("t").alias("target"))


@query(
    "true_false_cast",
    "O-65",
    """SELECT o_orderkey, CASE WHEN t IS NULL THEN NULL ELSE lower(trim(t)) = 'true' END AS flag
FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN ' True' WHEN 'O' THEN 'false ' END AS t FROM orders)""",
)
def q_true_false_cast(spark, sf):
    o = load(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", " True").when(F.col("o_orderstatus") == "O", "false ").alias("t")
    )
    return o.select("o_orderkey", T.true_false_cast("t").alias("flag"))


_STRIP = "trim(translate({c}, '[]''\"', ''))"
_STRICT = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"
_FIRST = r"'([-+]?\d*\.?\d+([eE][-+]?\d+)?)'"


def _coerce_sql(src: str, c: str) -> str:
    s = _STRIP.format(c=c)
    main = f"CASE WHEN regexp_matches({s}, {_STRICT}) THEN TRY_CAST({s} AS DOUBLE) END"
    fb = f"TRY_CAST(nullif(regexp_extract({s}, {_FIRST}, 1), '') AS DOUBLE)"
    return f"""SELECT event_id, coalesce(CASE WHEN (SELECT bool_or(regexp_matches({s}, {_STRICT})) FROM {src} x)
  THEN {main} ELSE {fb} END, 0.0) AS {c} FROM {src} y"""


_QUOTED_SQL = """(SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a'
  ELSE '[''' || CAST(value AS VARCHAR) || ''']' END AS num FROM events)"""


@query("coerce_numeric_fallback", "O-66", _coerce_sql("events", "props"))
def q_coerce_numeric_fallback(spark, sf):
    return coerce_numeric(load(spark, sf, "events").select("event_id", "props"), ["props"])


@query("coerce_numeric", "O-66", _coerce_sql(_QUOTED_SQL, "num"))
def q_coerce_numeric(spark, sf):
    e = load(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("n/a"))
        .otherwise(F.concat(F.lit("['"), F.col("value").cast("string"), F.lit("']")))
        .alias("num"),
    )
    return coerce_numeric(e, ["num"])


@query(
    "unwrap_singleton",
    "O-67",
    """SELECT vec_id, CASE len(a) WHEN 0 THEN NULL WHEN 1 THEN CAST(a[1] AS VARCHAR)
  ELSE '[' || array_to_string(a, ',') || ']' END AS value
FROM (SELECT vec_id, ([vec_id, label, vec_id + label])[1:(label % 4)] AS a FROM embeddings)""",
)
def q_unwrap_singleton(spark, sf):
    e = load(spark, sf, "embeddings").select("vec_id", F.col("label").cast("long").alias("label"))
    a = F.slice(F.array("vec_id", "label", F.col("vec_id") + F.col("label")), F.lit(1), (F.col("label") % 4).cast("int"))
    return e.select("vec_id", N.unwrap_singleton(a).alias("value"))


@query(
    "threshold_small",
    "O-68",
    f"SELECT vec_id, feature, {s6('CASE WHEN abs(value) > 0.1 THEN value ELSE 0.0 END')} AS value FROM {EMB_LONG_SQL} e",
)
def q_threshold_small(spark, sf):
    long = embeddings_long(spark, sf)
    return long.select("vec_id", "feature", N.r6(N.threshold_small("value", 0.1)).alias("value"))


_LABEL_DOCS_SQL = """(SELECT l.doc_id, l.quality, l.toxic, d.lang FROM labels l JOIN documents d USING (doc_id))"""


def labels_with_lang(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", "lang")
    return load(spark, sf, "labels").join(d, "doc_id")


@query(
    "active_label_string",
    "O-74",
    f"""SELECT doc_id, coalesce(nullif(concat_ws('|',
  CASE WHEN lang = 'de' THEN 'de' END, CASE WHEN lang = 'en' THEN 'en' END,
  CASE WHEN lang = 'es' THEN 'es' END, CASE WHEN lang = 'fr' THEN 'fr' END,
  CASE WHEN coalesce(lower(trim(CAST(quality AS VARCHAR))) IN ('yes', 'positive', '+', '1', 'true'), false) THEN 'quality' END,
  CASE WHEN coalesce(lower(trim(CAST(toxic AS VARCHAR))) IN ('yes', 'positive', '+', '1', 'true'), false) THEN 'toxic' END),
  ''), 'none') AS active_labels FROM {_LABEL_DOCS_SQL} t""",
)
def q_active_label_string(spark, sf):
    from ..operators.encode import get_dummies

    base = labels_with_lang(spark, sf)
    dummies = get_dummies(base, {"lang": ["de", "en", "es", "fr"]})
    dummy_cols = [c for c in dummies.columns if c.startswith("lang_")]
    dummies = dummies.select("doc_id", "quality", "toxic", *[F.col(c).cast("int").alias(c) for c in dummy_cols])
    return dummies.select(
        "doc_id", T.active_label_string(dummy_cols, ["quality", "toxic"], strip_prefix="lang_").alias("active_labels")
    )


@query(
    "presence_flag",
    "O-75",
    "SELECT o_orderkey, nullif(o_orderstatus, 'P') IS NOT NULL AS present FROM orders",
)
def q_presence_flag(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.expr("nullif(o_orderstatus, 'P')").alias("s"))
    return o.select("o_orderkey", T.presence_flag("s").alias("present"))


@query(
    "argmax_columns",
    "O-76",
    """SELECT doc_id, CASE WHEN quality IS NULL AND toxic IS NULL THEN NULL
  WHEN toxic > quality OR quality IS NULL THEN 'toxic' ELSE 'quality' END AS argmax FROM labels""",
)
def q_argmax_columns(spark, sf):
    return load(spark, sf, "labels").select("doc_id", A.argmax_columns(["quality", "toxic"]).alias("argmax"))


@query(
    "row_sum_labels",
    "O-77",
    "SELECT doc_id, CAST(coalesce(quality, 0) + coalesce(toxic, 0) AS BIGINT) AS n_active FROM labels",
)
def q_row_sum_labels(spark, sf):
    return load(spark, sf, "labels").select("doc_id", A.row_sum_labels(["quality", "toxic"]).alias("n_active"))


@query(
    "join_text_columns",
    "O-78",
    """SELECT p_partkey, concat_ws('||', coalesce(p_brand, 'nan'), coalesce(nullif(p_type, 'PROMO'), 'nan'),
  coalesce(p_name, 'nan')) AS joined FROM part""",
)
def q_join_text_columns(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", "p_brand", F.expr("nullif(p_type, 'PROMO')").alias("p_type"), "p_name")
    return p.select("p_partkey", T.join_text_columns(["p_brand", "p_type", "p_name"]).alias("joined"))


@query(
    "sanitize_name",
    "O-79",
    "SELECT p_partkey, translate(lower(trim(p_name || ' / ' || p_brand)), ' /\\', '___') AS clean FROM part",
)
def q_sanitize_name(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", F.concat("p_name", F.lit(" / "), "p_brand").alias("n"))
    return p.select("p_partkey", T.sanitize_name("n").alias("clean"))


@query(
    "mean_abs_over_classes",
    "O-81",
    f"""SELECT vec_id, CAST(feature // 4 AS BIGINT) AS feature, {s6('avg(abs(value))')} AS mean_abs
FROM {EMB_LONG_SQL} e GROUP BY vec_id, feature // 4""",
)
def q_mean_abs_over_classes(spark, sf):
    from ..operators.score import mean_abs_over_classes

    long = embeddings_long(spark, sf).select(
        "vec_id", (F.col("feature") / 4).cast("long").alias("feature"), (F.col("feature") % 4).alias("cls"), "value"
    )
    out = mean_abs_over_classes(long, ["vec_id", "feature"], "value")
    return out.select("vec_id", "feature", N.r6("mean_abs").alias("mean_abs"))


@query(
    "non_finite_to_null",
    "O-82",
    """SELECT event_id, CASE WHEN isnan(v) OR isinf(v) THEN NULL ELSE v END AS v FROM (
  SELECT event_id, CASE WHEN event_type = 'error' THEN CAST('inf' AS DOUBLE)
    WHEN event_type = 'view' THEN CAST('nan' AS DOUBLE) WHEN event_type = 'click' THEN CAST('-inf' AS DOUBLE)
    ELSE value END AS v FROM events)""",
)
def q_non_finite_to_null(spark, sf):
    e = load(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit(float("inf")))
        .when(F.col("event_type") == "view", F.lit(float("nan")))
        .when(F.col("event_type") == "click", F.lit(float("-inf")))
        .otherwise(F.col("value"))
        .alias("v"),
    )
    return e.select("event_id", N.non_finite_to_null("v").alias("v"))


@query(
    "numeric_feature_frame",
    "O-108",
    """SELECT coalesce(o_orderkey, 0) AS o_orderkey, coalesce(o_custkey, 0) AS o_custkey,
  coalesce(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END, 0.0) AS o_totalprice,
  CAST(coalesce(CAST(nullif(o_orderstatus, 'P') = 'F' AS BIGINT), 0) AS BIGINT) AS is_finished FROM orders""",
)
def q_numeric_feature_frame(spark, sf):
    o = load(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("o_totalprice"),
        (F.expr("nullif(o_orderstatus, 'P')") == "F").alias("is_finished"),
        "o_orderpriority",
    )
    return numeric_feature_frame(o)


@query(
    "one_hot_sparse",
    "O-72",
    """WITH o AS (SELECT o_orderkey, o_orderpriority, CAST(o_custkey AS VARCHAR) AS cust, CAST(o_orderdate AS VARCHAR) AS day FROM orders),
v AS (SELECT cust, row_number() OVER (ORDER BY cust) - 1 AS slot
  FROM (SELECT DISTINCT cust FROM o WHERE o_orderpriority <> '5-LOW' AND cust IS NOT NULL)),
d AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS slot
  FROM (SELECT DISTINCT day FROM o WHERE o_orderpriority <> '5-LOW' AND day IS NOT NULL)),
n AS (SELECT count(*) AS n FROM v)
SELECT o_orderkey, CAST(v.slot AS BIGINT) AS slot, 1.0::DOUBLE AS value FROM o JOIN v USING (cust)
UNION ALL
SELECT o_orderkey, CAST(n.n + d.slot AS BIGINT), 1.0::DOUBLE FROM o JOIN d USING (day), n""",
)
def q_one_hot_sparse(spark, sf):
    """Two columns of many values, fitted on a part of the orders and applied to all, as the vector's non-zero slots."""
    text = [F.col("o_custkey").cast("string").alias("cust"), F.col("o_orderdate").cast("string").alias("day")]
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", *text)
    model = E.fit_one_hot_vectors(o.where("o_orderpriority <> '5-LOW'"), ["cust", "day"])
    out = E.one_hot_vectors(o, model).select("o_orderkey", F.explode(E.vector_slots("onehot")).alias("s"))
    return out.select("o_orderkey", F.col("s.slot").cast("long").alias("slot"), "s.value")
