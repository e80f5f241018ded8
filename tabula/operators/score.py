"""Scoring helpers: attribution aggregation, linear attribution, permutation importance (O-81, O-103a, O-103c)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .metrics import classification_report, regression_metrics
from .split import hash_row_number


def mean_abs_over_classes(long: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """O-81: 3-D attribution (row, feature, class) → mean |v| over classes per (row, feature)."""
    return long.groupBy(*keys).agg(F.avg(F.abs(F.col(value))).alias("mean_abs"))


def linear_attribution(long: DataFrame, coefs: DataFrame, means: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """O-103a: φ = β_j · (x − mean_train(x_j)) per (row, feature), exact for linear models.

    ``long`` is (row id, column, value); ``coefs`` (keys, column, coef) and
    ``means`` (keys, column, mean) are bounded by #features and broadcast.
    Σ_j φ = prediction − mean prediction on the training rows.
    """
    p = coefs.join(means, [*keys, "column"])
    j = long.join(F.broadcast(p), [*keys, "column"])
    return j.withColumn("attribution", F.col("coef") * (F.col("value") - F.col("mean")))


def permutation_importance(model, x: DataFrame, id_col: str, features: Sequence[str], label: str, seed: int = 42,
                           task: str = "regression") -> DataFrame:
    """O-103c: (feature, score, permuted_score, importance): how much the model's score (R², or class-weighted F1)
    falls on ``x`` when a feature's values are dealt to other rows.

    Rows are numbered 0 to n - 1 in md5(id:seed) order. For the j-th feature (from 0) row k has the value of row
    (k + n (j + 1) div (features + 1)) mod n, a turn of that order, so one numbering serves all features, every value
    is used once, and with at least as many rows as features + 1 no row keeps its own. Each row sends its values to
    the rows that get them (features x rows small records, gathered by row number), then stands once per feature and
    once as it is; one ``transform`` and one grouped pass give all scores. An empty table gives no rows; ids must be
    distinct.
    """
    feats, n = list(features), x.count()
    if not n:
        return x.sparkSession.createDataFrame([], "feature string, score double, permuted_score double, importance double")
    turns = [n * (j + 1) // (len(feats) + 1) for j in range(len(feats))]
    ranked = hash_row_number(x, [], id_col, seed, out="__k", group_sizes={0: n})
    ranked = ranked.select("__k", F.col(label).alias("__y"), *[F.col(f"`{f}`").cast("double").alias(f"__f{j}") for j, f in enumerate(feats)])
    ranked = ranked.withColumn("__k", F.col("__k") - 1)
    sent = F.array(*[
        F.struct(F.pmod(F.col("__k") - t, F.lit(n)).alias("to"), F.lit(j).alias("j"), F.col(f"__f{j}").alias("v"))
        for j, t in enumerate(turns)
    ])
    got = ranked.select(F.explode(sent).alias("s")).groupBy(F.col("s.to").alias("__to")).agg(
        *[F.max(F.when(F.col("s.j") == j, F.col("s.v"))).alias(f"__p{j}") for j in range(len(feats))]
    )
    rows = ranked.join(got, ranked["__k"] == got["__to"])
    rows = rows.withColumn("__j", F.explode(F.sequence(F.lit(-1), F.lit(len(feats) - 1))))
    dealt = [F.when(F.col("__j") == j, F.col(f"__p{j}")).otherwise(F.col(f"__f{j}")).alias(f) for j, f in enumerate(feats)]
    pred = model.transform(rows.select("__j", "__y", *dealt)).select("__j", "__y", "prediction")
    if task == "regression":
        scores = regression_metrics(pred, "__y", "prediction", ["__j"]).select("__j", F.col("r2").alias("score"))
    else:
        classes = pred.select("__j", F.col("__y").cast("double").alias("__y"), "prediction")
        report = classification_report(classes, "__y", "prediction", ["__j"])
        scores = report.where("label = 'weighted avg'").select("__j", F.col("f1").alias("score"))
    names = F.array(*[F.lit(f) for f in feats])
    base = scores.where("__j = -1").select(F.lit(1).alias("__one"), F.col("score").alias("score"))
    each = scores.where("__j >= 0").select(
        F.lit(1).alias("__one"), F.element_at(names, F.col("__j") + 1).alias("feature"), F.col("score").alias("permuted_score")
    )
    out = each.join(F.broadcast(base), "__one")  # one row
    return out.select("feature", "score", "permuted_score", (F.col("score") - F.col("permuted_score")).alias("importance"))
