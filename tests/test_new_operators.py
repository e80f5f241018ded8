"""Correlation with NULLs, sparse one-hot vectors and permutation importance on fixtures."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabula.operators import encode as E
from tabula.operators import model as ML
from tabula.operators.score import permutation_importance
from tabula.operators.stats import correlation_long


def wide(n: int, d: int, seed: int = 1) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) + rng.normal(size=(n, 1))
    x[:, 1] += 1e6  # far from zero
    x[rng.random((n, d)) < 0.2] = np.nan
    return pd.DataFrame(x, columns=[f"c{i}" for i in range(d)])


@pytest.mark.parametrize("d", [2, 5, 90])
def test_correlation_of_any_width_with_nulls(spark, d):
    pdf = wide(300, d)
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"{c} double" for c in pdf)).repartition(3)
    got = correlation_long(df, list(pdf.columns)).toPandas().pivot(index="col_a", columns="col_b", values="corr")
    want = pdf.corr()
    assert got.loc[want.index, want.columns].to_numpy() == pytest.approx(want.to_numpy(), abs=1e-9)


def test_correlation_without_variance(spark):
    """A pair without variance has no correlation, and a column with such a pair goes (so here all go)."""
    rows = [(float(i), 0.1, float(i * i), None, float(i % 2)) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, same double, b double, none double, c double")
    assert correlation_long(df, df.columns).count() == 0
    assert correlation_long(df, ["a", "b", "none"]).count() == 0
    got = correlation_long(df, ["a", "b", "c"]).collect()
    assert {r["col_a"] for r in got} == {"a", "b", "c"} and len(got) == 9
    assert correlation_long(df.where("a < 0"), ["a", "b"]).count() == 0
    assert correlation_long(df, ["a"]).count() == 0


def test_fifty_thousand_categories_encode_and_train(spark):
    n = 50_000
    df = spark.range(2 * n).select(
        (F.col("id") % n).cast("string").alias("cat"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("kind"),
        (F.col("id") % 5).cast("double").alias("num"), F.when(F.col("id") % 3 == 0, 2.0).otherwise(-1.0).alias("y"),
    )
    model = E.fit_one_hot_vectors(df, ["cat", "kind"])
    assert len(E.one_hot_slots(model)) == n + 2
    x = E.one_hot_vectors(df, model)
    assert x.first()["onehot"].size == n + 2 and len(x.first()["onehot"].indices) == 2
    fit = Pipeline(stages=[ML.assemble(["onehot", "num"]), LinearRegression(labelCol="y", solver="l-bfgs", maxIter=5, regParam=0.1)]).fit(x)
    kinds = dict(zip(E.one_hot_slots(model), fit.stages[-1].coefficients))
    assert kinds["kind", "x"] > 0 > kinds["kind", "y"]


def test_sparse_one_hot_of_unseen_and_null(spark):
    train = spark.createDataFrame([("b", "q"), ("a", "p"), (None, "p"), ("c", None)], "u string, v string")
    model = E.fit_one_hot_vectors(train, ["u", "v"])
    assert E.one_hot_slots(model) == [("u", "a"), ("u", "b"), ("u", "c"), ("v", "p"), ("v", "q")]
    rows = spark.createDataFrame([("a", "q"), ("z", "p"), (None, "q"), ("c", None), (None, None)], "u string, v string")
    got = E.one_hot_vectors(rows, model).select("onehot", E.vector_slots("onehot").alias("s")).collect()
    assert [r["onehot"].toArray().tolist() for r in got] == [
        [1, 0, 0, 0, 1], [0, 0, 0, 1, 0], [0, 0, 0, 0, 1], [0, 0, 1, 0, 0], [0, 0, 0, 0, 0],
    ]
    assert [[p["slot"] for p in r["s"]] for r in got] == [[0, 4], [3], [4], [2], []]
    assert E.one_hot_vectors(rows.limit(0), model).count() == 0


@pytest.mark.parametrize("task", ["regression", "classification"])
def test_permutation_importance(spark, task):
    rng = np.random.default_rng(3)
    x = rng.random((400, 3))
    y = 3 * x[:, 0] + x[:, 1] if task == "regression" else (x[:, 0] > 0.5).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "id long, a double, b double, c double, y double")
    made = LinearRegression(labelCol="y", solver="normal") if task == "regression" else ML.RandomForestClassifier(labelCol="y", numTrees=5, seed=1)
    model = ML.selection_pipeline(["a", "b", "c"], made).fit(df)
    got = {r["feature"]: r for r in permutation_importance(model, df.repartition(5), "id", ["a", "b", "c"], "y", task=task).collect()}
    assert set(got) == {"a", "b", "c"} and got["a"]["score"] > 0.9
    assert got["a"]["importance"] > max(got["b"]["importance"], 0.2) and abs(got["c"]["importance"]) < 0.05
    assert all(r["importance"] == pytest.approx(r["score"] - r["permuted_score"]) for r in got.values())
    again = {r["feature"]: r["importance"] for r in permutation_importance(model, df, "id", ["a", "b", "c"], "y", task=task).collect()}
    assert again == {f: pytest.approx(r["importance"]) for f, r in got.items()}
    assert permutation_importance(model, df.limit(0), "id", ["a", "b", "c"], "y", task=task).count() == 0


def ols(spark, features):
    rows = [tuple(float((i * (j + 3)) % 11) for j in range(len(features))) + (float(i % 11) * 2 + 1,) for i in range(40)]
    train = spark.createDataFrame(rows, ", ".join(f"`{f}` double" for f in features) + ", y double")
    return ML.selection_pipeline(features, LinearRegression(labelCol="y", solver="normal", regParam=0.1)).fit(train)


BATCH = "id long, n double, cat string, flag boolean, none double"


def test_scoring_without_a_run_fits_on_the_batch(spark):
    from tabula.plans.scoring import batch_score_unfitted, prepare_batch

    rows = [(1, 1.0, "a", True, None), (2, None, None, None, None), (3, 4.0, "b", False, None), (3, 10.0, "a", True, None), (None, None, "a", None, None)]
    batch = spark.createDataFrame(rows, BATCH)
    ready = prepare_batch(batch, "id").collect()
    assert [(r["n"], r["cat_a"], r["cat_unknown"], r["flag_True"], r["flag_unknown"], r["none"]) for r in ready] == [
        (1.0, 1.0, 0.0, 1.0, 0.0, None), (4.0, 0.0, 1.0, 0.0, 1.0, None), (4.0, 0.0, 0.0, 0.0, 0.0, None),
        (10.0, 1.0, 0.0, 1.0, 0.0, None), (4.0, 1.0, 0.0, 0.0, 1.0, None),
    ]
    model = ols(spark, ["n", "cat_a", "cat_z"])
    out = batch_score_unfitted(batch, "id", ["n", "cat_a", "cat_z"], model, "e").collect()
    want = model.transform(spark.createDataFrame([(r["n"], r["cat_a"], 0.0) for r in ready], "n double, cat_a double, cat_z double"))
    assert [r["e_prediction"] for r in out] == pytest.approx([r["prediction"] for r in want.collect()])
    assert batch_score_unfitted(batch.limit(0), "id", ["n", "cat_a", "cat_z"], model, "e").count() == 0


def test_stream_without_a_run_fits_on_each_epoch(spark, tmp_path):
    from tabula.streaming.scoring import read_scores, score_stream_unfitted

    src = str(tmp_path / "in")
    spark.createDataFrame([(1, 2.0, "a", True, 0.0), (2, None, "a", None, 0.0)], BATCH).coalesce(1).write.parquet(src)
    spark.createDataFrame([(3, 8.0, "b", True, 0.0), (4, None, "a", None, 0.0)], BATCH).coalesce(1).write.mode("append").parquet(src)
    model = ols(spark, ["n", "cat_a"])
    stream = spark.readStream.schema(BATCH).option("maxFilesPerTrigger", 1).parquet(src)
    score_stream_unfitted(stream, "id", ["n", "cat_a"], model, "e", str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    got = {r["id"]: r["n"] for r in read_scores(spark, str(tmp_path / "out")).collect()}
    assert got == {1: 2.0, 2: 2.0, 3: 8.0, 4: 8.0}  # each epoch's own median


def test_map_entries_of_odd_maps(spark):
    from tabula.operators.runlog import map_columns, map_entries

    rows = [("a", {"m": 1.5, "nothing": None}, {"p": "x"}), ("b", None, {}), ("c", {f"k{i}": float(i) for i in range(20_000)}, None)]
    runs = spark.createDataFrame(rows, "run_id string, metrics map<string,double>, params map<string,string>")
    got = map_entries(runs)
    assert {tuple(r) for r in got.where("run_id <> 'c'").collect()} == {
        ("a", "metric", "m", 1.5, None), ("a", "metric", "nothing", None, None), ("a", "param", "p", None, "x"),
    }
    assert got.where("run_id = 'c'").count() == 20_000
    assert [tuple(r) for r in map_columns(runs, ["metric.k7", "param.p"]).orderBy("run_id").collect()] == [
        ("a", None, "x"), ("b", None, None), ("c", 7.0, None),
    ]


def test_quality_control_sets_preprocessing(spark):
    from tabula.plans.preprocess import apply_preprocess, fit_preprocess
    from tabula.plans.qc import spec_from_qc

    rows = [(i % 45, f"c{i % 2}", float(i % 7) if i else 1e6, "Yes" if i % 3 else "no", f"v{i % 30}", float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, cohort string, n double, seen string, many string, y double")
    got = spec_from_qc(df, "id", "cohort", ["y"], seq_col="y")
    assert (got.has_duplicates, got.boolean_cast_columns, got.outlier_columns, got.high_cardinality_columns) == (
        True, ["seen"], ["n"], ["many"],
    )
    params = fit_preprocess(df, got)
    assert list(params["clip"]) == ["n"] and list(params["rare"]) == ["many"]
    assert apply_preprocess(df, params, got, is_train=True).count() == 45
    none = spec_from_qc(df.select("id", "cohort", "y").dropDuplicates(["id"]), "id", "cohort", ["y"])
    assert (none.has_duplicates, none.boolean_cast_columns, none.outlier_columns, none.high_cardinality_columns) == (False, [], [], [])
