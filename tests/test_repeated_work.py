"""Steps that several queries share do their work once, in the tasks, and give what the plain way gives."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.feature import VarianceThresholdSelector
from pyspark.sql import functions as F

from tabula.operators import model as ML
from tabula.operators.profile import dedupe_first
from tabula.plans import scoring
from tabula.plans.preprocess import PrepSpec, fit_preprocess

from .conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(5)
    rows = [(i, rng.random(), rng.random(), float(rng.randint(0, 1)), 1.0, i % 2, i // 2 % 2) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, x double, z double, w double, same double, a int, b int").coalesce(1)
    return df.withColumn("y", 2 * F.col("x") + F.when(F.col("z") > 0.5, 3.0).otherwise(0.0) + F.col("w")).cache()


def test_first_rows_do_not_pass_through_the_driver(spark):
    rows = [(1, 2, "b"), (1, 1, "a"), (2, 5, "c"), (None, 3, "d"), (None, 4, "e")]
    out = dedupe_first(spark.createDataFrame(rows, "id long, seq long, v string"), "id", "seq")
    assert "Broadcast" not in plan(out)
    assert sorted(r["v"] for r in out.collect()) == ["a", "c", "d"]


def test_fit_finds_first_rows_once(spark, table, monkeypatch):
    from tabula.plans import preprocess

    seen = []
    monkeypatch.setattr(preprocess, "fit_coercion", lambda df, cols: seen.append(plan(df)) or {})
    rows = table.select("id", F.lit("c").alias("cohort"), "x", "z", "y").unionAll(
        table.limit(3).select("id", F.lit("d").alias("cohort"), "x", "z", "y")
    )
    fit_preprocess(rows, PrepSpec(id_col="id", cohort_col="cohort", targets=["y"], has_duplicates=True, seq_col="x"))
    assert "Join" not in seen[0] and "FileScan" in seen[0]


def test_prepared_rows_are_written_once(spark):
    from tabula.catalog import models

    assert "Join" not in plan(models.entities(spark, SF_SMALL))
    x, _, _ = models._prepared(spark, SF_SMALL, "regression")
    assert "FileScan" in plan(x) and "Aggregate" not in plan(x)


def test_features_are_selected_once_for_all_labels(spark, table, monkeypatch):
    fits, fit = [], VarianceThresholdSelector.fit
    monkeypatch.setattr(VarianceThresholdSelector, "fit", lambda self, df, *a: fits.append(1) or fit(self, df, *a))
    cols = ["x", "z", "w", "same"]

    def make(lab):
        return ML.RandomForestClassifier(labelCol=lab, featuresCol="features", seed=1, numTrees=3, maxDepth=3)

    models = ML.fit_per_label(table, cols, ["a", "b"], make)
    assert len(fits) == 1
    for lab, model in models.items():
        own = ML.selection_pipeline(cols, make(lab)).fit(table)
        assert own.stages[-1].toDebugString == model.stages[-1].toDebugString.replace(model.stages[-1].uid, own.stages[-1].uid)


def test_coalitions_stay_in_their_task(spark, table, monkeypatch):
    cols = ["x", "z", "w", "same"]
    model = ML.selection_pipeline(cols, ML.RandomForestRegressor(labelCol="y", seed=2, numTrees=4, maxDepth=4)).fit(table)
    rows = table.unionAll(table.limit(4)).withColumn("id", F.when(F.col("id") > 5, F.col("id"))).withColumn(
        "z", F.when(F.col("id") != 9, F.col("z"))
    )
    out = scoring.permutation_shapley(model, rows, "id", cols, n_perm=3, n_background=4)
    assert "Window" not in plan(out)
    got = {(r["id"], r["feature"]): r["attribution"] for r in out.collect()}
    monkeypatch.setattr(scoring, "KINDS", {})  # every coalition as a row of its own
    want = {(r["id"], r["feature"]): r["attribution"] for r in scoring.permutation_shapley(model, rows, "id", cols, 3, 4).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
