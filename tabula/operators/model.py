"""Model selection on Spark ML (O-88, O-91..O-98).

Every candidate is a ``Pipeline(VectorAssembler → VarianceThresholdSelector →
estimator)``; tuning runs over the stratified folds of O-53, so fold assignment
is reproducible, and every fit is distributed by Spark ML.

The search over a grid fits as little as the grid needs. A fold's features are assembled and selected once, kept, and
shared by all candidates, grid points and targets (``FoldFrames``). Grid points that differ only in the number of
trees (or boosting rounds) and in the depth of a forest are stages of one fit (``operators.ensemble``), scored
together in one pass over the fold's validation rows: the regression forest's 12 points take 2 fits a fold, a
classification forest's 24 points 4, boosting's 32 points 16.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VarianceThresholdSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from .ensemble import class_stage_scores, joint_stage_scores, stage_scores, trees_of

SEED = 42
# The reference's search grids. Depth "None" becomes Spark's maximum (30); min_samples_split has no
# counterpart in Spark.
RF_GRID = {"numTrees": [100, 200], "maxDepth": [30, 10, 20], "minInstancesPerNode": [1, 2]}
RF_CLASS_WEIGHT = [None, "balanced"]
GBT_GRID = {"maxIter": [100, 200], "maxDepth": [3, 6], "stepSize": [0.05, 0.1], "subsamplingRate": [0.8, 1.0],
            "featureSubsetStrategy": ["0.8", "all"]}


#: Deep forests: rows keep the node they are in instead of walking down all trees again for every level.
DEEP = {"cacheNodeIds": True, "maxMemoryInMB": 512}


@dataclass
class Candidate:
    name: str
    estimator: object
    grid: dict = field(default_factory=dict)
    weighted: bool = False
    per_class: bool = False


def assemble(cols: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep")


def selection_pipeline(cols: Sequence[str], estimator) -> Pipeline:
    """O-88 + model: variance > 0 selection fitted inside each training fold, then the estimator."""
    return Pipeline(stages=[
        assemble(cols, "__raw"),
        VarianceThresholdSelector(featuresCol="__raw", outputCol="features", varianceThreshold=0.0),
        estimator,
    ])


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """'balanced' weights n / (k · count(class)) as a column (small per-class table broadcast)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__c"))
    tot = counts.agg(F.sum("__c").alias("__n"), F.count(F.lit(1)).alias("__k")).withColumn("__one", F.lit(1))
    w = counts.withColumn("__one", F.lit(1)).join(tot, "__one").select(
        label, (F.col("__n") / (F.col("__k") * F.col("__c"))).alias(out)
    )
    return df.join(F.broadcast(w), label, "left")


def regression_candidates(label: str = "label", grid_scale: str = "full") -> list[Candidate]:
    """O-93 + O-94: OLS and a random forest regressor."""
    lr = LinearRegression(labelCol=label, featuresCol="features", solver="normal", regParam=0.0)
    rf = RandomForestRegressor(labelCol=label, featuresCol="features", seed=SEED, **DEEP)
    grid = RF_GRID if grid_scale == "full" else {"numTrees": [20], "maxDepth": [5]}
    return [Candidate("linear_regression", lr, {}), Candidate("random_forest", rf, grid)]


def classification_candidates(label: str = "label", grid_scale: str = "full", binary: bool = True) -> list[Candidate]:
    """O-95 + O-96: random forest (with and without balanced weights) and gradient-boosted trees.

    Spark boosts two classes; for more there is one boosted model per class, a row's class being that of the greatest
    share (``fit_per_class``).
    """
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", seed=SEED, **DEEP)
    rfw = RandomForestClassifier(labelCol=label, featuresCol="features", seed=SEED, weightCol="weight", **DEEP)
    rf_grid = RF_GRID if grid_scale == "full" else {"numTrees": [20], "maxDepth": [5]}
    out = [Candidate("random_forest", rf, rf_grid), Candidate("random_forest_balanced", rfw, rf_grid, weighted=True)]
    gbt = GBTClassifier(labelCol=label, featuresCol="features", seed=SEED)
    g = GBT_GRID if grid_scale == "full" else {"maxIter": [10], "maxDepth": [3]}
    out.append(Candidate("boosted_trees" if binary else "boosted_trees_per_class", gbt, g, per_class=not binary))
    return out


def evaluator_for(task: str, label: str = "label"):
    if task == "regression":
        return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="r2")
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="f1")


#: Grid axes whose values are stages of one fit, made at their greatest value.
STAGED = {"RandomForestRegressor": ("numTrees", "maxDepth"), "RandomForestClassifier": ("numTrees", "maxDepth"),
          "GBTClassifier": ("maxIter",)}


@dataclass
class Fold:
    train: DataFrame
    valid: DataFrame
    counts: dict[str, dict[float, int]]


#: Cells (rows x features) that a partition of a fold's kept rows holds at least, if there are as many.
PARTITION_CELLS = 500_000


class FoldFrames:
    """Each fold's training and validation rows with selected ``features``, kept for the whole search.

    Selection (variance > 0) is fitted on the training rows of the fold. ``labels`` are carried along; training rows
    per class are counted on first use, one small aggregation a fold and label.
    """

    def __init__(self, df: DataFrame, cols: Sequence[str], labels: Sequence[str], fold_col: str = "fold"):
        raw = assemble(cols, "__raw").transform(df).select("__raw", *labels, fold_col)
        raw = raw.persist()
        self.folds, self.kept = [], [raw]
        sizes = {r[0]: r[1] for r in raw.groupBy(fold_col).count().collect()}
        # tree fits run many small jobs: small tables lie in few partitions, large ones stay as they are
        raw = raw.coalesce(max(1, math.ceil(sum(sizes.values()) * len(cols) / PARTITION_CELLS)))
        for k in sorted(sizes):
            train = raw.where(F.col(fold_col) != k)
            select = VarianceThresholdSelector(featuresCol="__raw", outputCol="features", varianceThreshold=0.0).fit(train)
            both = [select.transform(r).select("features", *labels).persist() for r in (train, raw.where(F.col(fold_col) == k))]
            self.kept += both
            self.folds.append(Fold(*both, {}))

    def train(self, fold: Fold, label: str, weighted: bool) -> DataFrame:
        if not weighted:
            return fold.train
        if label not in fold.counts:
            fold.counts[label] = {r[0]: r[1] for r in fold.train.groupBy(F.col(label).cast("double")).count().collect()}
        return fold.train.withColumn("weight", balanced_weight(F.col(label).cast("double"), fold.counts[label]))

    def release(self) -> None:
        for df in self.kept:
            df.unpersist()


def balanced_weight(label, counts: dict[float, int]):
    """n / (k · count(class)) by class, as an expression."""
    n, k = sum(counts.values()), len(counts)
    weights = F.create_map(*[F.lit(v) for c, m in counts.items() for v in (float(c), n / (k * m))])
    return F.element_at(weights, label)


def points_of(grid: dict) -> list[dict]:
    """The points of a grid in the order of its axes, the last one fastest."""
    out = [{}]
    for name, values in grid.items():
        out = [{**p, name: v} for p in out for v in values]
    return out


def fit_groups(estimator, points: Sequence[dict]) -> list[tuple[dict, list[int], list[tuple[int, int | None]]]]:
    """Points that are stages of one fit: (parameters of the fit, the points' positions, their stages)."""
    staged = STAGED.get(type(estimator).__name__, ())
    groups: dict[tuple, list[int]] = {}
    for i, p in enumerate(points):
        key = tuple(sorted((k, repr(v)) for k, v in p.items() if k not in staged))
        groups.setdefault(key, []).append(i)
    out = []
    for members in groups.values():
        fit = dict(points[members[0]])
        for axis in staged:
            if axis in fit:
                fit[axis] = max(points[i][axis] for i in members)
        full = {k: fit.get(k, estimator.getOrDefault(k)) for k in staged}
        stages = [
            (points[i].get(staged[0], full[staged[0]]), points[i].get("maxDepth", full["maxDepth"]) if "maxDepth" in staged else None)
            for i in members
        ] if staged else []
        out.append((fit, members, stages))
    return out


def with_params(estimator, params: dict, **more):
    return estimator.copy({estimator.getParam(k): v for k, v in {**params, **more}.items()})


def grid_search(df: DataFrame, cols: Sequence[str], cand: Candidate, task: str, fold_col: str = "fold",
                label: str = "label", parallelism: int | None = None, frames: FoldFrames | None = None):
    """O-91: CV over the candidate's grid on the given folds; best refit on all rows.

    Class weights are fitted on each fold's training rows, so validation rows have no part in them. A grid point
    whose score is not a number on some fold counts as the worst. Folds and fits run concurrently, ``parallelism`` at
    once (None: ``fits_at_once``); ``frames`` shares the folds' features with other candidates.
    Returns (mean CV score of the best grid point, fitted best PipelineModel or, of a candidate per class,
    PerClassModel).
    """
    mean, point = search_grid(df, cols, cand, task, fold_col, label, parallelism, frames)
    return mean, refit(df, cols, cand, point, label)


def search_grid(df: DataFrame, cols: Sequence[str], cand: Candidate, task: str, fold_col: str = "fold", label: str = "label",
                parallelism: int | None = None, frames: FoldFrames | None = None) -> tuple[float, dict]:
    """(mean CV score, parameters) of the best grid point, without the refit on all rows."""
    metric = evaluator_for(task, label)

    def score(train: Callable, valid: DataFrame, fit: dict, stages: list) -> list[float]:
        if cand.per_class:
            models = _each_class(train(label), label, lambda r, y: with_params(cand.estimator, fit, labelCol=y).fit(r))
            trees = {c: trees_of(m, df.sparkSession) for c, m in models.items()}
            return class_stage_scores(trees, valid, label, stages)
        model = with_params(cand.estimator, fit).fit(train(label))
        if stages:
            return stage_scores(trees_of(model, df.sparkSession), valid, label, stages)
        return [metric.evaluate(model.transform(valid))]

    return _search(df, cols, cand, [label], score, fold_col, parallelism, frames)


def refit(df: DataFrame, cols: Sequence[str], cand: Candidate, point: dict, label: str):
    """The candidate at a grid point, fitted on all rows."""
    rows = class_weights(df, label) if cand.weighted else df
    if cand.per_class:
        return fit_per_class(rows, cols, label, with_params(cand.estimator, point))
    return selection_pipeline(cols, with_params(cand.estimator, point)).fit(rows)


def grid_search_per_label(df: DataFrame, cols: Sequence[str], cand: Candidate, labels: Sequence[str],
                          fold_col: str = "fold", parallelism: int | None = None, frames: FoldFrames | None = None,
                          scoring: str = "f1_samples"):
    """O-91 for O-97 and O-98: as ``grid_search`` with one binary model per label column and one point for all.

    A point's score is taken over all labels together: ``f1_samples`` (mean over rows) or ``f1_weighted`` (F1 of each
    label weighted by its number of true rows). Class weights are fitted per label on each fold's training rows.
    Returns (mean CV score of the best grid point, {label: PipelineModel fitted on all rows}).
    """
    mean, point = search_grid_per_label(df, cols, cand, labels, fold_col, parallelism, frames, scoring)
    return mean, refit_per_label(df, cols, cand, point, labels)


def search_grid_per_label(df: DataFrame, cols: Sequence[str], cand: Candidate, labels: Sequence[str],
                          fold_col: str = "fold", parallelism: int | None = None, frames: FoldFrames | None = None,
                          scoring: str = "f1_samples") -> tuple[float, dict]:
    """(mean CV score, parameters) of the best grid point, without the refits on all rows."""
    def score(train: Callable, valid: DataFrame, fit: dict, stages: list) -> list[float]:
        models = {lab: with_params(cand.estimator, fit, labelCol=lab).fit(train(lab)) for lab in labels}
        trees = {lab: trees_of(m, df.sparkSession) for lab, m in models.items()}
        return joint_stage_scores(trees, valid, stages, scoring)

    return _search(df, cols, cand, labels, score, fold_col, parallelism, frames)


def refit_per_label(df: DataFrame, cols: Sequence[str], cand: Candidate, point: dict, labels: Sequence[str]) -> dict:
    """The candidate at a grid point, fitted on all rows for each label."""
    return _each_label(df, cols, labels, lambda lab: with_params(cand.estimator, point, labelCol=lab), cand.weighted)


def fits_at_once(spark) -> int:
    """Fits of a search that run side by side: more than cores, since a fit of a small table is one task at a time and
    the driver's work between its jobs leaves the core idle."""
    return max(8, 3 * spark.sparkContext.defaultParallelism // 2)


def _search(df, cols, cand: Candidate, labels, score: Callable, fold_col: str, parallelism: int | None, frames: FoldFrames | None):
    """(mean score, parameters) of the best grid point; the first of equal ones."""
    points = points_of(cand.grid)
    groups = fit_groups(cand.estimator, points)
    own = frames or FoldFrames(df, cols, labels, fold_col)

    def run(job) -> list[float]:
        fold, (fit, _, stages) = job
        return score(lambda lab: own.train(fold, lab, cand.weighted), fold.valid, fit, stages)

    try:
        jobs = [(f, g) for g in groups for f in own.folds]
        with ThreadPoolExecutor(parallelism or fits_at_once(df.sparkSession)) as pool:
            got = list(pool.map(inheritable_thread_target(df.sparkSession)(run), jobs))
    finally:
        if frames is None:
            own.release()
    scores: list[list[float]] = [[] for _ in points]
    for (_, (_, members, _)), values in zip(jobs, got):
        for i, v in zip(members, values):
            scores[i].append(float("-inf") if v != v else v)
    means = [sum(s) / len(s) for s in scores]
    best = max(range(len(points)), key=lambda i: means[i])
    return means[best], points[best]


def _each_class(rows: DataFrame, label: str, fit: Callable) -> dict[float, object]:
    """``fit(rows, 0/1 column)`` for every class of ``label``."""
    classes = sorted(r[0] for r in rows.select(F.col(label).cast("double")).distinct().collect() if r[0] is not None)
    return {c: fit(rows.withColumn("__own", (F.col(label).cast("double") == c).cast("double")), "__own") for c in classes}


@dataclass
class PerClassModel:
    """One boosted pipeline per class; ``transform`` adds ``prediction``, the class of the greatest share, and
    ``probability``, the classes' shares normalised to one."""

    models: dict[float, PipelineModel]

    def transform(self, df: DataFrame) -> DataFrame:
        out, shares = df, []
        for i, m in enumerate(self.models.values()):
            out = m.transform(out).select(*df.columns, *shares, vector_to_array("probability")[1].alias(f"__share{i}"))
            shares.append(f"__share{i}")
        greatest = F.greatest(*shares) if len(shares) > 1 else F.col(shares[0])
        first = F.coalesce(*[F.when(F.col(s) == greatest, F.lit(c)) for c, s in zip(self.models, shares)])
        total = sum((F.col(s) for s in shares[1:]), F.col(shares[0]))
        return out.select(
            *df.columns, first.alias("prediction"), F.array(*[F.col(s) / total for s in shares]).alias("probability")
        )


def fit_per_class(df: DataFrame, cols: Sequence[str], label: str, estimator) -> PerClassModel:
    """O-96 for several classes: one boosted model for each class against the others, classes in ascending order."""
    fits = _each_class(df, label, lambda rows, y: selection_pipeline(cols, estimator.copy({estimator.labelCol: y})).fit(rows))
    return PerClassModel(fits)


def select_model(results: Sequence[tuple[str, float, object]]):
    """O-92: highest CV score wins; strict '>' keeps the first of equal scores."""
    best = None
    for name, score, model in results:
        if best is None or score > best[1]:
            best = (name, score, model)
    return best


def fit_per_label(df: DataFrame, cols: Sequence[str], labels: Sequence[str], make: Callable[[str], object]) -> dict:
    """O-97 / O-98: one binary pipeline per label column over the same (cached) frame."""
    return _each_label(df, cols, labels, make)


def _each_label(df: DataFrame, cols: Sequence[str], labels: Sequence[str], make: Callable[[str], object],
                weighted: bool = False) -> dict:
    """A fitted pipeline per label. Labels have no part in the selection of features, so it is fitted once for all."""
    front = Pipeline(stages=selection_pipeline(cols, None).getStages()[:-1]).fit(df)
    rows = front.transform(df)
    return {
        lab: PipelineModel([*front.stages, make(lab).fit(class_weights(rows, lab) if weighted else rows)]) for lab in labels
    }


def predict_per_label(models: dict, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Apply per-label models; adds ``<label>_pred`` columns (one narrow transform each)."""
    out = df
    for lab, m in models.items():
        out = m.transform(out).withColumnRenamed("prediction", f"{lab}_pred").drop(
            "__raw", "features", "rawPrediction", "probability"
        )
    return out.select(*keep, *[f"{lab}_pred" for lab in models])


def linear_coefficients(model: PipelineModel, cols: Sequence[str]) -> list[tuple[str, float]]:
    """Coefficients of a fitted linear pipeline mapped back to column names (after selection)."""
    sel, lr = model.stages[1], model.stages[-1]
    kept = [cols[i] for i in sel.selectedFeatures]
    return list(zip(kept, [float(c) for c in lr.coefficients])) + [("__intercept__", float(lr.intercept))]
