"""Batch scoring (O-102) and attribution (O-81, O-103).

Scoring is a stateless projection (preprocess apply + ``PipelineModel.transform``),
so the same function serves batch and streaming DataFrames.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.encode import fit_categories, fit_medians, impute, one_hot
from ..operators.ensemble import FOREST_REGRESSION, KINDS, coalition_attribution
from ..operators.relational import align_features, categorical_columns, numeric_columns
from ..operators.runlog import best_run, run_log_append, run_log_scan
from ..operators.split import sample_n
from ..sources.files import fitted_sink, fitted_source, model_load, model_save
from .preprocess import PrepSpec, apply_preprocess


def batch_score(new: DataFrame, params: dict, spec: PrepSpec, model, experiment: str) -> DataFrame:
    """O-102: apply fitted preprocessing and the model; outputs ``<experiment>_prediction``.

    Missing trained features are filled with 0 (strict alignment, O-17); the
    training-only cohort centring is not applied to new rows.
    """
    x = apply_preprocess(new, params, spec, is_train=False)
    pred = model.transform(x)
    return pred.select(spec.id_col, F.col("prediction").alias(f"{experiment}_prediction"))


def save_run(spark: SparkSession, root: str, run: dict, params: dict, models: Sequence) -> None:
    """Store a fitted run below ``root``: preprocessing, one model per target, and its row of the run log.

    ``run`` has run_id, experiment_id, start_time and metrics; the row is written last, so a run that is in the log
    is complete.
    """
    fitted_sink(spark, params, f"{root}/fitted/{run['run_id']}")
    for i, m in enumerate(models):
        model_save(m, f"{root}/models/{run['run_id']}/{i}")
    row = (run["run_id"], "FINISHED", run["start_time"], {k: float(v) for k, v in run["metrics"].items()}, len(models), run["experiment_id"])
    schema = "run_id string, status string, start_time long, metrics map<string,double>, n_models int, experiment_id string"
    run_log_append(spark.createDataFrame([row], schema), f"{root}/runs")


def load_best_run(spark: SparkSession, root: str, experiment: str, metric_priority: Sequence[str]) -> tuple[dict, list]:
    """Preprocessing and models of the best finished run of an experiment (O-58, O-04, O-07)."""
    runs = run_log_scan(spark.read.parquet(f"{root}/runs"), experiment)
    best = best_run(runs, metric_priority, with_model=runs.where("n_models > 0")).first()
    n = runs.where(F.col("run_id") == best["run_id"]).first()["n_models"]
    models = [model_load(f"{root}/models/{best['run_id']}/{i}") for i in range(n)]
    return fitted_source(spark, f"{root}/fitted/{best['run_id']}"), models


def batch_score_targets(new: DataFrame, params: dict, spec: PrepSpec, models: Sequence, experiment: str) -> DataFrame:
    """O-102 for one or several targets: ``<experiment>_prediction``, or ``<experiment>_prediction_<i>`` for each.

    Every row of ``new`` is scored, repeated ids too.
    """
    if len(models) == 1:
        return batch_score(new, params, spec, models[0], experiment)
    x, made = apply_preprocess(new, params, spec, is_train=False), []
    for i, m in enumerate(models):
        made.append(f"{experiment}_prediction_{i}")
        x = m.transform(x).select(*x.columns, F.col("prediction").alias(made[-1]))
    return x.select(spec.id_col, *made)


def prepare_batch(new: DataFrame, id_col: str, carry: Sequence[str] = ()) -> DataFrame:
    """O-102 without a stored run: imputation and encoding fitted on the batch itself.

    Numeric NULLs become the batch's median, text and boolean NULLs ``unknown``; every category of the batch becomes a
    0/1 column ``<column>_<value>``. No clipping, centring or scaling, as nothing was fitted for it. ``id_col`` and
    ``carry`` stay as they are. A numeric column that is all NULL stays NULL; an empty batch gives no rows (and no
    category columns).
    """
    kept = [id_col, *carry]
    cat = [c for c in categorical_columns(new) if c not in kept]
    num = [c for c in numeric_columns(new) if c not in kept]
    medians = {r["column"]: r["median"] for r in fit_medians(new, num, id_col).collect()} if num else {}
    filled = impute(new, {c: medians.get(c) for c in num}, cat)
    return one_hot(filled, fit_categories(filled, cat)) if cat else filled


def batch_score_unfitted(new: DataFrame, id_col: str, features: Sequence[str], model, experiment: str,
                         carry: Sequence[str] = ()) -> DataFrame:
    """O-102 without a stored run: the prepared batch in the model's feature order (features that the batch does not
    give are 0) and ``<experiment>_prediction``."""
    ready = prepare_batch(new, id_col, carry)
    x = align_features(ready, [id_col, *carry, *features], strict=True)
    pred = model.transform(x)
    return pred.select(id_col, *carry, *[F.col(f"`{c}`") for c in features], F.col("prediction").alias(f"{experiment}_prediction"))


def permutation_shapley(model, x: DataFrame, id_col: str, features: Sequence[str], n_perm: int = 8,
                        n_background: int = 20, seed: int = 42) -> DataFrame:
    """O-103b: sampled permutation Shapley values per (row, feature).

    For each row, ``n_perm`` feature orders (fixed, seeded) × ``n_background``
    background rows (O-110 sample, a bounded literal) × (features + 1) coalition
    sizes are scored by one ``transform``; φ_j is the mean change in prediction
    when feature j joins its predecessors. The expansion is a fixed-width explode
    of literals per row (no join); per-row work is bounded by the parameters.
    """
    feats = list(features)
    nf = len(feats)
    rng = random.Random(seed)
    perms = []
    for _ in range(n_perm):
        p = list(range(nf))
        rng.shuffle(p)
        perms.append(p)
    # rank of each feature inside each permutation (position 0..nf-1)
    ranks = [[p.index(j) for j in range(nf)] for p in perms]
    bg_rows = sample_n(x.select(id_col, *feats), id_col, n_background).collect()  # ≤ n_background rows
    if KINDS.get(type(model.stages[-1]).__name__) == FOREST_REGRESSION:
        background = [[float(r[f]) if r[f] is not None else 0.0 for f in feats] for r in bg_rows]
        parts = coalition_attribution(model, x, id_col, feats, perms, background)
        return parts.groupBy(id_col, "feature").agg(F.avg("attribution").alias("attribution"))
    bg = F.array(*[F.array(*[F.lit(float(r[f]) if r[f] is not None else 0.0) for f in feats]) for r in bg_rows])
    rank_arr = F.array(*[F.array(*[F.lit(v) for v in rk]) for rk in ranks])
    perm_arr = F.array(*[F.array(*[F.lit(v) for v in p]) for p in perms])
    combos = F.array(*[
        F.struct(F.lit(pi).alias("pi"), F.lit(k).alias("k"), F.lit(b).alias("b"))
        for pi in range(n_perm) for k in range(nf + 1) for b in range(len(bg_rows))
    ])
    e = x.select(id_col, *[F.col(f"`{f}`").cast("double").alias(f) for f in feats]).select(
        "*", F.explode(combos).alias("__c")
    ).select("*", "__c.pi", "__c.k", "__c.b").drop("__c")
    hybrid = [
        F.when(F.element_at(F.element_at(rank_arr, F.col("pi") + 1), j + 1) < F.col("k"), F.col(f"`{f}`"))
        .otherwise(F.element_at(F.element_at(bg, F.col("b") + 1), j + 1)).alias(f)
        for j, f in enumerate(feats)
    ]
    scored = model.transform(e.select(id_col, "pi", "k", "b", *hybrid)).select(id_col, "pi", "k", "prediction")
    g = scored.groupBy(id_col, "pi", "k").agg(F.avg("prediction").alias("v"))
    w = Window.partitionBy(id_col, "pi").orderBy("k")  # groups of nf + 1 rows
    d = g.withColumn("delta", F.col("v") - F.lag("v").over(w)).where(F.col("k") > 0)
    d = d.withColumn("fi", F.element_at(F.element_at(perm_arr, F.col("pi") + 1), F.col("k")))
    names = F.array(*[F.lit(f) for f in feats])
    return d.groupBy(id_col, "fi").agg(F.avg("delta").alias("attribution")).select(
        id_col, F.element_at(names, F.col("fi") + 1).alias("feature"), "attribution"
    )
