"""Leave-one-cohort-out experiment (O-90) and the entity table used to exercise it.

Driver loop over the (few, bounded) cohorts; inside each fold every step is a
Spark job: preprocessing fit/apply (O-89), stratified inner folds (O-53),
cross-validated grid search per candidate (O-91), strict-greater selection
(O-92), held-out metrics (O-99..O-101). Fold inputs are cut from lineage with a
reliable checkpoint so the loop keeps plans short and survives executor loss.
The inner folds' features are made once a cohort and shared by all candidates.

Tasks: ``regression`` (one target), ``multiclass_classification`` of one target or of its one-hot columns (O-98:
one model a column, one grid point for all, scored by weighted F1), ``multilabel_classification`` (O-97).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..functions.arrays import row_sum_labels
from ..operators import metrics as M
from ..operators import model as ML
from ..operators.runlog import FINISHED, run_log_replace
from ..operators.split import cohort_list, qcut_rank_bins, stratified_folds
from ..session import cut_lineage, stored
from .preprocess import PrepSpec, apply_preprocess, fit_preprocess


def stratum_column(df: DataFrame, spec: PrepSpec) -> DataFrame:
    """O-52: regression → rank-first quantile bins; multilabel → active count; else the label text."""
    if spec.task == "regression":
        return qcut_rank_bins(df, spec.targets[0], spec.id_col, out="__stratum").withColumn(
            "__stratum", F.col("__stratum").cast("string")
        )
    if len(spec.targets) > 1:
        return df.withColumn("__stratum", row_sum_labels(spec.targets).cast("string"))
    return df.withColumn("__stratum", F.col(spec.targets[0]).cast("string"))


def evaluate(pred: DataFrame, spec: PrepSpec, keys: Sequence[str] = ()) -> DataFrame:
    if spec.task == "regression":
        return M.regression_metrics(pred, spec.targets[0], "prediction", keys)
    if len(spec.targets) > 1:
        return M.multilabel_metrics(pred, spec.targets, [f"{t}_pred" for t in spec.targets], keys)
    rep = M.classification_report(pred, spec.targets[0], "prediction", keys)
    acc = rep.where(F.col("label") == "accuracy").select(*keys, F.col("f1").alias("accuracy"))
    wf1 = rep.where(F.col("label") == "weighted avg").select(*keys, F.col("f1").alias("f1_weighted"))
    return acc.join(wf1, list(keys)) if keys else acc.withColumn("__o", F.lit(1)).join(wf1.withColumn("__o", F.lit(1)), "__o").drop("__o")


@dataclass
class Experiment:
    """What a leave-one-cohort-out experiment found; each a DataFrame.

    ``summary``: a row per held-out cohort (sizes, selected model, its CV score, held-out metrics). ``candidates``: the
    best CV score of every candidate. ``per_target``: metrics of each target. ``reports``: the classification report of
    each target (O-100), without rows for a regression. ``runs``: rows of a run log, one per cohort.
    """

    summary: DataFrame
    candidates: DataFrame
    per_target: DataFrame
    reports: DataFrame
    runs: DataFrame


def per_target_metrics(pred: DataFrame, spec: PrepSpec, held_out: str) -> tuple[DataFrame, DataFrame]:
    """(metrics of each target, classification report of each target) of held-out predictions."""
    spark = pred.sparkSession
    if spec.task == "regression":
        m = M.regression_metrics(pred, spec.targets[0], "prediction")
        long = m.select(F.lit(held_out).alias("held_out"), F.lit(spec.targets[0]).alias("target"), "*").unpivot(
            ["held_out", "target"], ["r2", "mae", "rmse"], "metric", "value"
        )
        return long, spark.createDataFrame([], REPORT)
    reports = []
    for t in spec.targets:
        guess = "prediction" if len(spec.targets) == 1 else f"{t}_pred"
        rows = pred.select(F.col(f"`{t}`").cast("int").alias("y"), F.col(f"`{guess}`").cast("int").alias("p"))
        rep = M.classification_report(rows, "y", "p")
        reports.append(rep.select(F.lit(held_out).alias("held_out"), F.lit(t).alias("target"), *rep.columns))
    report = stored(reduce(DataFrame.unionByName, reports), "report")
    metric = F.when(F.col("label") == "accuracy", "accuracy").when(F.col("label") == "weighted avg", "f1_weighted")
    long = report.where(F.col("label").isin("accuracy", "weighted avg"))
    return long.select("held_out", "target", metric.alias("metric"), F.col("f1").alias("value")), report


REPORT = "held_out string, target string, label string, precision double, recall double, f1 double, support long"


def search_candidates(folded: DataFrame, features: Sequence[str], spec: PrepSpec, candidates: Sequence[ML.Candidate],
                      parallelism: int | None = None) -> tuple[list[tuple[str, float]], str, float, Callable[[], Callable]]:
    """All candidates over the folds, on shared features: (name, best CV score) of each; name and score of the
    selected one, and a function that refits it on all rows and returns what adds its predictions to rows
    (``prediction``, or ``<target>_pred`` of each target)."""
    frames = ML.FoldFrames(folded, features, spec.targets)
    one = len(spec.targets) == 1
    scoring = "f1_samples" if spec.task == "multilabel_classification" else "f1_weighted"
    results = []
    try:
        for cand in candidates:
            if one:
                score, point = ML.search_grid(folded, features, cand, spec.task, "fold", spec.targets[0], parallelism, frames)
            else:
                score, point = ML.search_grid_per_label(
                    folded, features, cand, spec.targets, "fold", parallelism, frames, scoring
                )
            results.append((cand.name if one else f"{cand.name}_per_label", score, (cand, point)))
    finally:
        frames.release()
    name, score, (cand, point) = ML.select_model(results)

    def fitted() -> Callable[[DataFrame], DataFrame]:
        if one:
            model = ML.refit(folded, features, cand, point, spec.targets[0])
        else:
            model = ML.refit_per_label(folded, features, cand, point, spec.targets)

        def predict(rows: DataFrame) -> DataFrame:
            keep = [c for c in rows.columns if c in (spec.id_col, *spec.targets)]
            return model.transform(rows).select(*keep, "prediction") if one else ML.predict_per_label(model, rows, keep)

        return predict

    return [(n, float(s)) for n, s, _ in results], name, float(score), fitted


def run_loco(df: DataFrame, spec: PrepSpec, grid_scale: str = "full", max_splits: int = 5, experiment: str = "experiment",
             candidates: Sequence[ML.Candidate] | None = None, parallelism: int = 4, cohorts_at_once: int = 3) -> Experiment:
    """O-90: the experiment with everything it reports. ``candidates`` replace the task's own.

    ``cohorts_at_once`` cohorts run side by side, each with ``parallelism`` fits.
    """
    spark, n_rows = df.sparkSession, df.count()

    def run(c: str) -> tuple:
        is_test = F.col(spec.cohort_col).cast("string").eqNullSafe(F.lit(c))
        train_raw = cut_lineage(df.where(~is_test))
        params = fit_preprocess(train_raw, spec)
        train = cut_lineage(apply_preprocess(train_raw, params, spec, is_train=True))
        test = stored(apply_preprocess(df.where(is_test), params, spec, is_train=False), "held-out")
        feats = params["features"]
        folded = cut_lineage(stratified_folds(stratum_column(train, spec), "__stratum", spec.id_col, max_splits=max_splits))
        found, name, score, fitted = search_candidates(
            folded, feats, spec, candidates or candidates_for(spec, params, grid_scale), parallelism
        )
        pred = stored(fitted()(test), "predictions")
        metric = stored(evaluate(pred.withColumn("held_out", F.lit(c)), spec, ["held_out"]), "metrics")
        n_folds = folded.select(F.max("fold")).first()[0] + 1
        row = (c, name, score, train.count(), test.count(), len(feats), n_folds, len(params["categorical"]), len(params["numeric"]))
        return row, metric, *per_target_metrics(pred, spec, c), [(c, n, s, n == name) for n, s in found]

    cohorts = cohort_list(df, spec.cohort_col)
    with ThreadPoolExecutor(cohorts_at_once) as pool:
        rows, metrics, targets, reports, tried = zip(*pool.map(inheritable_thread_target(spark)(run), cohorts))
    meta = spark.createDataFrame(rows, "held_out string, selected_model string, cv_score double, n_train long, n_test long, "
                                       "n_features int, inner_cv_splits int, n_categorical int, n_numeric int")
    allm = reduce(DataFrame.unionByName, metrics)
    summary = meta.drop("inner_cv_splits", "n_categorical", "n_numeric").join(allm, "held_out")
    scores = spark.createDataFrame([t for c in tried for t in c], "held_out string, model string, cv_score double, selected boolean")
    return Experiment(
        summary, scores, reduce(DataFrame.unionByName, targets), reduce(DataFrame.unionByName, reports),
        run_rows(meta, allm, spec, experiment, n_rows),
    )


def candidates_for(spec: PrepSpec, params: dict, grid_scale: str = "full") -> list[ML.Candidate]:
    """The task's candidates; classes of a single target decide between one boosted model and one per class."""
    if spec.task == "regression":
        return ML.regression_candidates(spec.targets[0], grid_scale)
    two = len(spec.targets) > 1 or len(params["classes"][spec.targets[0]]) <= 2
    return ML.classification_candidates(spec.targets[0], grid_scale, binary=two)


def run_rows(meta: DataFrame, metrics: DataFrame, spec: PrepSpec, experiment: str, n_rows: int) -> DataFrame:
    """O-06: one run-log row per held-out cohort: ids, tags, parameters and metrics. The run id is made of experiment
    and cohort, so a repeated experiment replaces its rows."""
    values = [c for c in metrics.columns if c not in ("held_out", "n")]
    wide = meta.join(metrics.select("held_out", *values), "held_out")

    def entries(named: dict, dtype: str):
        return F.map_from_entries(F.array(*[F.struct(F.lit(k), v.cast(dtype)) for k, v in named.items()]))

    numbers = {"cv_score": F.col("cv_score"), **{f"test_{c}": F.col(c) for c in values}}
    params = {k: F.col(k) for k in ("selected_model", "inner_cv_splits", "n_train", "n_test", "n_features", "n_categorical", "n_numeric")}
    tags = {"task_type": F.lit(spec.task), "target_columns": F.lit(",".join(spec.targets)), "held_out_cohort": F.col("held_out"),
            "outer_strategy": F.lit("leave_one_cohort_out"), "row_count": F.lit(n_rows)}
    run_id = F.concat_ws("_heldout_", F.lit(experiment), F.lower(F.regexp_replace("held_out", "[^A-Za-z0-9]+", "_")))
    return wide.select(
        run_id.alias("run_id"), run_id.alias("run_name"), F.lit(FINISHED).alias("status"), F.lit(None).cast("string").alias("parent_run_id"),
        F.unix_millis(F.current_timestamp()).alias("start_time"), F.map_filter(entries(numbers, "double"), lambda _, v: v.isNotNull()).alias("metrics"),
        entries(params, "string").alias("params"), entries(tags, "string").alias("tags"), F.lit(experiment).alias("experiment_id"),
    )


def loco_experiment(df: DataFrame, spec: PrepSpec, grid_scale: str = "full", max_splits: int = 5,
                    candidates: Sequence[ML.Candidate] | None = None, run_log: str | None = None,
                    experiment: str = "experiment") -> DataFrame:
    """One result row per held-out cohort: sizes, selected model, its CV score and held-out metrics.

    With ``run_log`` the cohorts' rows are put into that run log as well.
    """
    found = run_loco(df, spec, grid_scale, max_splits, experiment, candidates)
    if run_log:
        run_log_replace(found.runs, run_log)
    return found.summary


def entity_table(customer: DataFrame, nation: DataFrame, region: DataFrame, orders: DataFrame) -> DataFrame:
    """An entity table from the driver's tables: entity id, cohort, attributes, targets.

    Per customer: region (cohort), balance and segment (attributes), order
    statistics (numeric attributes), a positive/negative status text, and
    targets: mean order price (regression), urgent/high order flags (multilabel)
    and the segment (multiclass).
    """
    per = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.avg("o_totalprice").alias("mean_price"),
        F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("share_finished"),
        F.max((F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("has_urgent"),
        F.max((F.col("o_orderpriority") == "2-HIGH").cast("int")).alias("has_high"),
    )
    base = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .join(per, customer.c_custkey == per.o_custkey, "inner")
    )
    return base.select(
        F.col("c_custkey").alias("id"),
        F.col("r_name").alias("cohort"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_orders").cast("double").alias("n_orders"),
        "share_finished",
        F.when(F.col("c_acctbal") > 0, "Positive").otherwise("negative").alias("status"),
        (F.col("c_nationkey") / 10.0 - 1.2).alias("sig_a"),
        F.concat(F.lit("['"), ((F.col("c_custkey") % 7) / 2.0 - 1.5).cast("string"), F.lit("']")).alias("sig_b"),
        "mean_price",
        "has_urgent",
        "has_high",
    )
