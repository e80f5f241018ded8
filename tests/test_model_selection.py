"""Model selection runs the real search: staged scores against fits of their own, whole experiments on 200 rows."""

from __future__ import annotations

import dataclasses
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.operators import ensemble as E
from tabula.operators import model as ML
from tabula.plans.experiment import loco_experiment, run_loco
from tabula.plans.preprocess import PrepSpec


@pytest.fixture(scope="module")
def table(spark):
    """200 rows: a number that is nearly a step function, labels, classes, folds and cohorts."""
    rng = random.Random(11)
    rows = []
    for i in range(200):
        x, z, w = rng.random(), rng.random(), float(rng.randint(0, 3))
        y = (3.0 if x > 0.5 else 0.0) + 2 * z + w
        rows.append((i, x, z, w, 1.0, y + rng.gauss(0, 0.2), int(x + z > 1), int(w > 1), float(rng.randint(0, 1)), int(3 * x), i % 3, f"c{i % 2}"))
    names = "id long, x double, z double, w double, same double, y double, a int, b int, noise double, kind int, fold long, cohort string"
    return spark.createDataFrame(rows, names).coalesce(1).cache()


COLS = ["x", "z", "w", "same"]


def prepared(table, labels):
    return ML.FoldFrames(table, COLS, labels)


@pytest.mark.parametrize("depth", [1, 2, 4, 30])
@pytest.mark.parametrize("classes", [False, True])
def test_depth_stages_equal_fits_of_that_depth(spark, table, depth, classes):
    label = "a" if classes else "y"
    kind = ML.RandomForestClassifier if classes else ML.RandomForestRegressor
    fold = prepared(table, [label]).folds[0]
    grown = kind(labelCol=label, seed=3, numTrees=6, maxDepth=30).fit(fold.train)
    own = kind(labelCol=label, seed=3, numTrees=6, maxDepth=depth).fit(fold.train)
    want = ML.evaluator_for("multiclass" if classes else "regression", label).evaluate(own.transform(fold.valid))
    got = E.stage_scores(E.trees_of(grown, spark), fold.valid, label, [(6, depth), (6, 30)])
    assert got[0] == pytest.approx(want, abs=1e-9)


def test_round_stages_equal_fits_of_that_many_rounds(spark, table):
    fold = prepared(table, ["a"]).folds[0]
    rows = fold.train.withColumn("a", F.col("a").cast("double"))
    made = {n: ML.GBTClassifier(labelCol="a", seed=3, maxIter=n, maxDepth=3, subsamplingRate=0.8).fit(rows) for n in (2, 5)}
    want = [ML.evaluator_for("multiclass", "a").evaluate(made[n].transform(fold.valid)) for n in (2, 5)]
    assert E.stage_scores(E.trees_of(made[5], spark), fold.valid, "a", [(2, None), (5, None)]) == pytest.approx(want, abs=1e-9)


def test_tree_prefix_is_the_mean_of_its_trees(spark, table):
    fold = prepared(table, ["y"]).folds[0]
    model = ML.RandomForestRegressor(labelCol="y", seed=3, numTrees=5, maxDepth=4).fit(fold.train)
    rows = [r["features"] for r in fold.valid.select("features").collect()]
    got = E.trees_of(model, spark).staged(np.array([r.toArray() for r in rows]), [(2, 30), (5, 30)])
    each = np.array([[t.predict(r) for t in model.trees] for r in rows])
    assert got[:, 0] == pytest.approx(each[:, :2].mean(axis=1)) and got[:, 1] == pytest.approx(each.mean(axis=1))


@pytest.mark.parametrize("task, label, grid, n_fits", [
    ("regression", "y", ML.RF_GRID, 2),
    ("classification", "a", ML.GBT_GRID, 16),
])
def test_grids_need_few_fits(task, label, grid, n_fits):
    est = ML.RandomForestRegressor(labelCol=label) if task == "regression" else ML.GBTClassifier(labelCol=label)
    points = ML.points_of(grid)
    groups = ML.fit_groups(est, points)
    assert len(groups) == n_fits
    assert sorted(i for _, members, _ in groups for i in members) == list(range(len(points)))
    for fit, members, stages in groups:
        for i, (n, depth) in zip(members, stages):
            staged = {"numTrees": n, "maxDepth": depth} if task == "regression" else {"maxIter": n}
            assert {**fit, **staged} == points[i]


def test_search_takes_the_best_point(spark, table):
    forest = ML.RandomForestRegressor(labelCol="y", seed=3)
    cand = ML.Candidate("forest", forest, {"numTrees": [3, 8], "maxDepth": [0, 6], "minInstancesPerNode": [1, 60]})
    score, model = ML.grid_search(table, COLS, cand, "regression", "fold", "y")
    assert score > 0.7 and model.stages[-1].getMinInstancesPerNode() == 1
    assert model.stages[-1].getOrDefault("maxDepth") == 6
    assert model.stages[1].selectedFeatures == [0, 1, 2]  # the constant column goes


@pytest.mark.parametrize("weighted", [True, False])
@pytest.mark.parametrize("scoring", ["f1_samples", "f1_weighted"])
def test_grid_search_per_label(spark, weighted, scoring):
    """Of two depths the one that can tell the labels apart wins, with and without class weights."""
    rows = [(float(i % 4), float(i % 3 == 0), int(i % 4 in (1, 2)), int(i % 4 >= 2), i // 4 % 2) for i in range(48)]
    df = spark.createDataFrame(rows, "x double, z double, a int, b int, fold int").coalesce(1).cache()
    forest = ML.RandomForestClassifier(labelCol="a", seed=ML.SEED, **({"weightCol": "weight"} if weighted else {}))
    cand = ML.Candidate("random_forest", forest, {"numTrees": [5], "maxDepth": [0, 4]}, weighted)
    score, models = ML.grid_search_per_label(df, ["x", "z"], cand, ["a", "b"], scoring=scoring)
    # a quarter of the rows have no label: they count 0 in the mean over rows
    assert score == pytest.approx(0.75 if scoring == "f1_samples" else 1.0) and set(models) == {"a", "b"}
    got = ML.predict_per_label(models, df, ["a", "b"]).collect()
    assert all((r["a_pred"], r["b_pred"]) == (r["a"], r["b"]) for r in got)


def test_boosting_per_class(spark, table):
    df = table.withColumn("kind", F.col("kind").cast("double"))
    cand = ML.classification_candidates("kind", binary=False)[-1]
    assert cand.name == "boosted_trees_per_class" and cand.grid == ML.GBT_GRID
    cand = dataclasses.replace(cand, grid={"maxIter": [1, 6], "maxDepth": [3], "stepSize": [0.3]})
    score, model = ML.grid_search(df, COLS, cand, "classification", "fold", "kind")
    assert score > 0.9
    out = model.transform(df).collect()
    assert np.mean([r["prediction"] == r["kind"] for r in out]) > 0.95
    for r in out:
        assert sum(r["probability"]) == pytest.approx(1) and max(r["probability"]) == r["probability"][int(r["prediction"])]


def spec(task, targets):
    return PrepSpec(id_col="id", cohort_col="cohort", targets=targets, task=task)


def features(table, targets):
    return table.select("id", "cohort", "x", "z", "w", *targets)


def test_regression_experiment(spark, table, tmp_path):
    """The reference's whole forest grid on 200 rows, its report and its run log (written twice)."""
    from tabula.operators.runlog import best_run, run_log_replace, run_log_scan

    assert ML.regression_candidates("y")[1].grid == ML.RF_GRID
    got = run_loco(features(table, ["y"]), spec("regression", ["y"]), max_splits=2, experiment="outcome")
    rows = {r["held_out"]: r for r in got.summary.collect()}
    assert set(rows) == {"c0", "c1"}
    tried = {(r["held_out"], r["model"]): r for r in got.candidates.collect()}
    for c, r in rows.items():
        scores = {m: tried[c, m]["cv_score"] for m in ("linear_regression", "random_forest")}
        assert r["cv_score"] == max(scores.values()) and scores[r["selected_model"]] == r["cv_score"]
        assert r["n_train"] == 100 and r["n_test"] == 100 and r["r2"] > 0.5
    each = {(r["held_out"], r["metric"]): r["value"] for r in got.per_target.collect()}
    assert all(each[c, "r2"] == pytest.approx(r["r2"]) for c, r in rows.items())
    path = str(tmp_path / "runs")
    runs = got.runs.cache()
    run_log_replace(runs, path)
    run_log_replace(runs.where("run_id like '%c1'"), path)
    log = run_log_scan(spark.read.parquet(path), "outcome")
    kept = {r["run_id"]: r for r in log.collect()}
    assert set(kept) == {f"outcome_heldout_{c}" for c in rows}
    for r in kept.values():
        assert r["metrics"]["test_r2"] == pytest.approx(rows[r["tags"]["held_out_cohort"]]["r2"])
        assert r["params"]["selected_model"] == rows[r["tags"]["held_out_cohort"]]["selected_model"]
    best = best_run(log, ["test_r2"]).first()
    assert best["run_id"] == "outcome_heldout_" + max(rows, key=lambda c: rows[c]["r2"])


@pytest.mark.parametrize("task", ["multilabel_classification", "multiclass_classification"])
def test_label_experiments(spark, table, task):
    """Two label columns: independent labels, and one-hot columns searched by weighted F1; reports of each target."""
    grid = {"numTrees": [3, 6], "maxDepth": [1, 5]}
    cands = [dataclasses.replace(c, grid=grid) for c in ML.classification_candidates("a")[:2]]
    got = run_loco(features(table, ["a", "b"]), spec(task, ["a", "b"]), max_splits=2, candidates=cands)
    rows = got.summary.collect()
    assert len(rows) == 2 and all(r["subset_accuracy"] > 0.6 and r["selected_model"].endswith("_per_label") for r in rows)
    reports = got.reports.collect()
    assert {(r["held_out"], r["target"]) for r in reports} == {(f"c{i}", t) for i in range(2) for t in "ab"}
    mean = {}
    for r in got.per_target.where("metric = 'f1_weighted'").collect():
        mean.setdefault(r["held_out"], []).append(r["value"])
    assert all(np.mean(mean[r["held_out"]]) == pytest.approx(r["mean_target_f1_weighted"]) for r in rows)


def test_one_class_target_experiment(spark, table):
    grid = {"maxIter": [2, 4], "maxDepth": [3], "stepSize": [0.3]}
    cands = [dataclasses.replace(ML.classification_candidates("kind", binary=False)[-1], grid=grid)]
    out = loco_experiment(features(table, ["kind"]), spec("multiclass_classification", ["kind"]), max_splits=2, candidates=cands)
    rows = out.collect()
    assert len(rows) == 2 and all(r["accuracy"] > 0.8 and r["selected_model"] == "boosted_trees_per_class" for r in rows)


@pytest.mark.parametrize("make", [
    lambda: ML.RandomForestRegressor(labelCol="y", numTrees=5, maxDepth=5, seed=1),
    lambda: ML.RandomForestClassifier(labelCol="a", numTrees=5, maxDepth=5, seed=1),
    lambda: ML.GBTClassifier(labelCol="a", maxIter=4, maxDepth=3, seed=1),
])
def test_path_attribution_adds_up(spark, table, make):
    """A row's attributions sum to its output less the base; a recursion over the exported nodes gives the same."""
    model = ML.selection_pipeline(COLS, make()).fit(table)
    got = E.path_attribution(model, table, "id", COLS).collect()
    assert {r["feature"] for r in got} == {"x", "z", "w"}
    by: dict = {}
    for r in got:
        by.setdefault(r["id"], {})[r["feature"]] = r["attribution"]
    out = {r["id"]: r for r in model.transform(table).collect()}
    base = got[0]["base"]
    forest = type(model.stages[-1]).__name__
    for i, parts in by.items():
        if forest == "RandomForestRegressionModel":
            want = out[i]["prediction"]
        else:
            want = out[i]["probability"][1] if forest.startswith("Random") else out[i]["rawPrediction"][1]
        assert sum(parts.values()) + base == pytest.approx(want, abs=1e-9)
    if forest == "RandomForestRegressionModel":
        nodes = {(r["tree"], r["node"]): r for r in E.tree_nodes(model.stages[-1], spark).collect()}
        assert all(n["cover"] == pytest.approx(nodes[t, n["left"]]["cover"] + nodes[t, n["right"]]["cover"])
                   for (t, _), n in nodes.items() if n["left"] is not None)
        names = [COLS[i] for i in model.stages[1].selectedFeatures]
        for r in table.limit(20).collect():
            parts = dict.fromkeys(names, 0.0)
            for t in range(5):
                at = nodes[t, 0]
                while at["left"] is not None:
                    f = names[at["feature"]]
                    to = nodes[t, at["left"] if r[f] <= at["threshold"] else at["right"]]
                    parts[f] += (to["prediction"] - at["prediction"]) / 5
                    at = to
            assert by[r["id"]] == pytest.approx(parts)
