"""Bindings: run log, metrics, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..operators import metrics as M
from ..operators import runlog as RL
from ..operators import scale as SC
from ..operators.profile import melt
from ..sources import files as IO
from ..session import load
from .registry import query
from .sqlgen import long_sql
from .sqlgen import r6 as s6

# ----------------------------------------------------------------- run table
RUNS_SQL = """(SELECT 'run-' || CAST(e.event_id AS VARCHAR) AS run_id,
  e.event_type || '_heldout_' || CAST(e.user_id % 5 AS VARCHAR) AS run_name,
  e.event_type AS experiment_id,
  CASE WHEN e.value >= 5 THEN 'FINISHED' ELSE 'FAILED' END AS status,
  CAST(epoch_us(e.ts) // 1000 AS BIGINT) AS start_time,
  CASE WHEN e.event_id <> f.first_id THEN 'run-' || CAST(f.first_id AS VARCHAR) END AS parent_run_id,
  CASE WHEN e.event_type <> 'view' THEN e.value END AS m_score,
  CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS m_k,
  CASE WHEN e.event_type = 'purchase' THEN e.value / 50.0 END AS m_cv,
  'model_' || CAST(e.user_id % 3 AS VARCHAR) AS p_model,
  CASE WHEN e.event_type = 'error' THEN 'TRUE' ELSE 'FALSE' END AS p_skipped,
  CASE WHEN e.user_id % 4 <> 0 THEN 'stratified_cv' END AS t_strategy
FROM events e JOIN (SELECT user_id, min(event_id) AS first_id FROM events GROUP BY user_id) f USING (user_id))"""


def runs_table(spark, sf) -> DataFrame:
    """A run log derived from ``events`` (one run per event, parent = the user's first run)."""
    e = load(spark, sf, "events")
    first = e.groupBy("user_id").agg(F.min("event_id").alias("first_id"))
    j = e.join(first, "user_id")
    metrics = F.map_filter(
        F.create_map(
            F.lit("score"), F.when(F.col("event_type") != "view", F.col("value")),
            F.lit("k"), F.get_json_object("props", "$.k").cast("double"),
            F.lit("cv"), F.when(F.col("event_type") == "purchase", F.col("value") / 50.0),
        ),
        lambda k, v: v.isNotNull(),
    )
    params = F.create_map(
        F.lit("model"), F.concat(F.lit("model_"), (F.col("user_id") % 3).cast("string")),
        F.lit("skipped"), F.when(F.col("event_type") == "error", "TRUE").otherwise("FALSE"),
    )
    tags = F.map_filter(
        F.create_map(F.lit("strategy"), F.when(F.col("user_id") % 4 != 0, F.lit("stratified_cv"))),
        lambda k, v: v.isNotNull(),
    )
    return j.select(
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
        F.concat("event_type", F.lit("_heldout_"), (F.col("user_id") % 5).cast("string")).alias("run_name"),
        F.col("event_type").alias("experiment_id"),
        F.when(F.col("value") >= 5, "FINISHED").otherwise("FAILED").alias("status"),
        # epoch ms of a zone-less timestamp, independent of the session time zone
        F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) div 1000").alias("start_time"),
        F.when(F.col("event_id") != F.col("first_id"), F.concat(F.lit("run-"), F.col("first_id").cast("string")))
        .alias("parent_run_id"),
        metrics.alias("metrics"),
        params.alias("params"),
        tags.alias("tags"),
    )


@query(
    "run_log_scan",
    "O-05",
    f"SELECT run_id, run_name, status, start_time FROM {RUNS_SQL} r WHERE experiment_id = 'purchase' AND status = 'FINISHED'",
)
def q_run_log_scan(spark, sf):
    return RL.run_log_scan(runs_table(spark, sf), "purchase").select("run_id", "run_name", "status", "start_time")


@query("run_log_scan_all", "O-05", f"SELECT run_id, experiment_id, start_time FROM {RUNS_SQL} r WHERE status = 'FINISHED'")
def q_run_log_scan_all(spark, sf):
    return RL.run_log_scan(runs_table(spark, sf)).select("run_id", "experiment_id", "start_time")


@query("run_log_append", "O-06")
def q_run_log_append(spark, sf):
    """Append one summary row per (experiment, held-out fold) and read the run table back."""
    runs = runs_table(spark, sf)
    summary = runs.groupBy("experiment_id", "run_name").agg(
        F.count(F.lit(1)).cast("long").alias("n_runs"),
        F.avg(F.element_at("metrics", F.lit("score"))).alias("mean_score"),
    )
    path = IO.scratch_path(spark, "runlog")
    RL.run_log_append(summary, path)
    RL.run_log_append(summary.withColumn("n_runs", F.col("n_runs") * 0), path)
    return spark.read.parquet(path)


@query(
    "run_lineage",
    "O-25",
    f"""WITH r AS {RUNS_SQL}, k AS (SELECT parent_run_id, count(*) AS n FROM r WHERE parent_run_id IS NOT NULL
  GROUP BY parent_run_id)
SELECT r.run_id, r.parent_run_id, CAST(coalesce(k.n, 0) AS BIGINT) AS child_run_count,
  r.parent_run_id IS NOT NULL AS is_child_run, coalesce(k.n, 0) > 0 AS is_parent_run
FROM r LEFT JOIN k ON k.parent_run_id = r.run_id""",
)
def q_run_lineage(spark, sf):
    return RL.run_lineage(runs_table(spark, sf))


@query(
    "map_flatten",
    "O-80",
    f"""SELECT run_id, m_cv AS "metric.cv", m_k AS "metric.k", m_score AS "metric.score", p_model AS "param.model",
  p_skipped AS "param.skipped", t_strategy AS "tag.strategy" FROM {RUNS_SQL} r""",
)
def q_map_flatten(spark, sf):
    return RL.map_flatten(runs_table(spark, sf))


@query(
    "map_entries",
    "O-80",
    f"""WITH r AS (SELECT * FROM {RUNS_SQL} x), e AS (
  SELECT run_id, 'metric' AS kind, 'cv' AS key, m_cv AS number, NULL::VARCHAR AS text FROM r
  UNION ALL SELECT run_id, 'metric', 'k', m_k, NULL FROM r
  UNION ALL SELECT run_id, 'metric', 'score', m_score, NULL FROM r
  UNION ALL SELECT run_id, 'param', 'model', NULL, p_model FROM r
  UNION ALL SELECT run_id, 'param', 'skipped', NULL, p_skipped FROM r
  UNION ALL SELECT run_id, 'tag', 'strategy', NULL, t_strategy FROM r)
SELECT * FROM e WHERE number IS NOT NULL OR text IS NOT NULL""",
)
def q_map_entries(spark, sf):
    """Every entry of every run's maps as a row: no list of keys, no limit on them."""
    return RL.map_entries(runs_table(spark, sf))


@query(
    "map_columns",
    "O-80",
    f"""SELECT run_id, m_score AS "metric.score", p_model AS "param.model", NULL::VARCHAR AS "tag.nowhere" FROM {RUNS_SQL} r""",
)
def q_map_columns(spark, sf):
    """The wanted entries as columns, one of which no run has."""
    return RL.map_columns(runs_table(spark, sf), ["metric.score", "param.model", "tag.nowhere"])


@query(
    "best_run",
    "O-58",
    f"""SELECT run_id, coalesce(m_cv, m_score, m_k, CAST('-inf' AS DOUBLE)) AS score FROM {RUNS_SQL} r
WHERE experiment_id = 'purchase' AND p_model <> 'model_0'
ORDER BY score DESC, start_time DESC, run_id LIMIT 1""",
)
def q_best_run(spark, sf):
    runs = runs_table(spark, sf).where(F.col("experiment_id") == "purchase")
    models = runs.where(F.element_at("params", F.lit("model")) != "model_0").select("run_id")
    return RL.best_run(runs, ["cv", "score", "k"], with_model=models)


@query(
    "best_run_per_experiment",
    "O-58",
    f"""SELECT experiment_id, arg_min(run_id, struct_pack(a := -score, b := -start_time, c := run_id)) AS run_id,
  max(score) AS score FROM (SELECT experiment_id, run_id, start_time,
  coalesce(m_cv, m_score, m_k, CAST('-inf' AS DOUBLE)) AS score FROM {RUNS_SQL} r) GROUP BY experiment_id""",
)
def q_best_run_per_experiment(spark, sf):
    return RL.best_run(runs_table(spark, sf), ["cv", "score", "k"], keys=["experiment_id"])


@query(
    "eval_report",
    "O-105",
    f"""WITH c AS (SELECT DISTINCT experiment_id, p_model, m_score, m_k FROM {RUNS_SQL} r
  WHERE p_skipped IS DISTINCT FROM 'TRUE' AND status = 'FINISHED'
    AND experiment_id IS NOT NULL AND p_model IS NOT NULL AND m_score IS NOT NULL AND m_k IS NOT NULL),
g AS (SELECT experiment_id, p_model, CAST(count(*) AS BIGINT) AS n_rows, avg(m_score) AS mean_score, avg(m_k) AS mean_k
  FROM c GROUP BY ALL)
SELECT experiment_id, p_model AS "param.model", n_rows, {s6('mean_score')} AS mean_score, {s6('mean_k')} AS mean_k,
  p_model = (SELECT arg_max(p_model, mean_score) FROM g g2 WHERE g2.experiment_id = g.experiment_id) AS is_best
FROM g""",
)
def q_eval_report(spark, sf):
    from ..plans.report import eval_report

    flat = RL.map_flatten(runs_table(spark, sf), base=["run_id", "experiment_id", "status"])
    out = eval_report(flat, "param.model", ["metric.score", "metric.k"], flag="param.skipped")
    return out.select("experiment_id", "`param.model`", "n_rows", r6("mean_score").alias("mean_score"),
                      r6("mean_k").alias("mean_k"), "is_best")


# ------------------------------------------------------------------- metrics
@query(
    "regression_metrics",
    "O-99",
    f"""SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n,
  {s6('1 - sum(power(l_extendedprice - l_quantity * 1500.0, 2)) / (var_pop(l_extendedprice) * count(*))')} AS r2,
  {s6('avg(abs(l_extendedprice - l_quantity * 1500.0))')} AS mae,
  {s6('sqrt(avg(power(l_extendedprice - l_quantity * 1500.0, 2)))')} AS rmse
FROM lineitem GROUP BY l_returnflag""",
)
def q_regression_metrics(spark, sf):
    li = load(spark, sf, "lineitem").withColumn("pred", F.col("l_quantity") * 1500.0)
    out = M.regression_metrics(li, "l_extendedprice", "pred", ["l_returnflag"])
    return out.select("l_returnflag", "n", r6("r2").alias("r2"), r6("mae").alias("mae"), r6("rmse").alias("rmse"))


LABEL_PRED_SQL = """(SELECT l.doc_id, l.quality, l.toxic, CAST(d.n_chars > 2000 AS INTEGER) AS quality_pred,
  CAST(d.lang = 'en' AS INTEGER) AS toxic_pred FROM labels l JOIN documents d USING (doc_id))"""


def labels_with_preds(spark, sf):
    d = load(spark, sf, "documents").select(
        "doc_id", (F.col("n_chars") > 2000).cast("int").alias("quality_pred"), (F.col("lang") == "en").cast("int").alias("toxic_pred")
    )
    return load(spark, sf, "labels").join(d, "doc_id")


@query(
    "classification_metrics",
    "O-100",
    f"""WITH t AS {LABEL_PRED_SQL},
c AS (SELECT label, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM (
  SELECT CAST(quality AS VARCHAR) AS label, CAST(quality = quality_pred AS BIGINT) AS tp, 0 AS fp,
         CAST(quality <> quality_pred AS BIGINT) AS fn FROM t
  UNION ALL SELECT CAST(quality_pred AS VARCHAR), 0, CAST(quality <> quality_pred AS BIGINT), 0 FROM t) GROUP BY label),
p AS (SELECT label, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall, tp + fn AS support FROM c),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM p),
u AS (SELECT label, precision, recall, f1, support FROM f
  UNION ALL SELECT 'accuracy', NULL, NULL, (SELECT sum(tp) FROM c) / sum(support), sum(support) FROM f
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM f
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support) FROM f)
SELECT label, {s6('precision')} AS precision, {s6('recall')} AS recall, {s6('f1')} AS f1,
  CAST(support AS BIGINT) AS support FROM u""",
)
def q_classification_metrics(spark, sf):
    out = M.classification_report(labels_with_preds(spark, sf), "quality", "quality_pred")
    return out.select("label", *[r6(c).alias(c) for c in ["precision", "recall", "f1"]], "support")


def _f1(tp, fp, fn):
    return f"CASE WHEN 2 * {tp} + {fp} + {fn} > 0 THEN 2.0 * {tp} / (2 * {tp} + {fp} + {fn}) ELSE 0.0 END"


def _multilabel_sql() -> str:
    parts = []
    for t in ["quality", "toxic"]:
        tp = f"sum(CAST({t} = 1 AND {t}_pred = 1 AS INTEGER))"
        fp = f"sum(CAST({t} = 0 AND {t}_pred = 1 AS INTEGER))"
        fn = f"sum(CAST({t} = 1 AND {t}_pred = 0 AS INTEGER))"
        tn = f"sum(CAST({t} = 0 AND {t}_pred = 0 AS INTEGER))"
        parts.append((tp, fp, fn, tn))
    macro = " + ".join(_f1(tp, fp, fn) for tp, fp, fn, _ in parts)
    weighted = " + ".join(
        f"(({_f1(tp, fp, fn)}) * ({tp} + {fn}) + ({_f1(tn, fn, fp)}) * ({tn} + {fp})) / count(*)" for tp, fp, fn, tn in parts
    )
    rtp = "(CAST(quality = 1 AND quality_pred = 1 AS INTEGER) + CAST(toxic = 1 AND toxic_pred = 1 AS INTEGER))"
    rfp = "(CAST(quality = 0 AND quality_pred = 1 AS INTEGER) + CAST(toxic = 0 AND toxic_pred = 1 AS INTEGER))"
    rfn = "(CAST(quality = 1 AND quality_pred = 0 AS INTEGER) + CAST(toxic = 1 AND toxic_pred = 0 AS INTEGER))"
    return f"""SELECT CAST(count(*) AS BIGINT) AS n,
  {s6('avg(CAST(quality = quality_pred AND toxic = toxic_pred AS DOUBLE))')} AS subset_accuracy,
  {s6(f'avg({_f1(rtp, rfp, rfn)})')} AS f1_samples,
  {s6(f'({macro}) / 2')} AS f1_macro, {s6(f'({weighted}) / 2')} AS mean_target_f1_weighted
FROM {LABEL_PRED_SQL} t"""


@query("multilabel_metrics", "O-101", _multilabel_sql())
def q_multilabel_metrics(spark, sf):
    out = M.multilabel_metrics(labels_with_preds(spark, sf), ["quality", "toxic"], ["quality_pred", "toxic_pred"])
    return out.select("n", *[r6(c).alias(c) for c in ["subset_accuracy", "f1_samples", "f1_macro", "mean_target_f1_weighted"]])


# -------------------------------------------------------------- sources/sinks
@query("csv_scan", "O-01", "SELECT * FROM nation")
def q_csv_scan(spark, sf):
    nation = load(spark, sf, "nation")
    path = IO.csv_sink(nation, IO.scratch_path(spark, "nation-csv"))
    return IO.csv_scan(spark, path, schema=nation.schema)


@query(
    "csv_sink",
    "O-02",
    """SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'F') AS o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def q_csv_sink(spark, sf):
    o = load(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.expr("nullif(o_orderstatus, 'F')").alias("o_orderstatus"), "o_totalprice",
        "o_orderdate", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    path = IO.csv_sink(o, IO.scratch_path(spark, "orders-csv"))
    return IO.csv_scan(spark, path, schema=o.schema)


@query(
    "tsv_sink",
    "O-03",
    f"""SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n, {s6('avg(l_quantity)')} AS mean_qty FROM lineitem
GROUP BY l_returnflag""",
)
def q_tsv_sink(spark, sf):
    m = load(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).cast("long").alias("n"), r6(F.avg("l_quantity")).alias("mean_qty")
    )
    path = IO.tsv_sink(m, IO.scratch_path(spark, "metrics-tsv"))
    return IO.csv_scan(spark, path, schema=m.schema, sep="\t")


NUM4 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "params_roundtrip",
    "O-04",
    f"""WITH l AS {long_sql('lineitem', NUM4, ids=['l_orderkey', 'l_linenumber'])},
p AS (SELECT column, avg(value) AS mean, stddev_samp(value) AS std FROM l GROUP BY column)
SELECT l.l_orderkey, l.l_linenumber, l.column,
  {s6('CASE WHEN p.std > 0 THEN (l.value - p.mean) / p.std ELSE l.value END')} AS value
FROM l JOIN p USING (column)""",
)
def q_params_roundtrip(spark, sf):
    long = melt(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], NUM4)
    params = long.groupBy("column").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")).select(
        "column", F.lit(SC.STANDARD).alias("decision"), F.lit(None).cast("double").alias("min"),
        F.lit(None).cast("double").alias("max"), "mean", "std", F.lit(None).cast("double").alias("median"),
        F.lit(None).cast("double").alias("iqr"),
    )
    path = IO.params_sink(params, IO.scratch_path(spark, "params"), fmt="json")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in params.schema.fields)
    loaded = IO.params_source(spark, path, fmt="json", schema=ddl)
    out = SC.apply_params_long(long, loaded)
    return out.select("l_orderkey", "l_linenumber", "column", r6("value").alias("value"))
