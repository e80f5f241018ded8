"""Property checks on the composite steps."""

import pytest
from pyspark.sql import functions as F

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def entities(spark):
    from tabula.plans.experiment import entity_table
    from tabula.session import load

    return entity_table(load(spark, SF_SMALL, "customer"), load(spark, SF_SMALL, "nation"),
                         load(spark, SF_SMALL, "region"), load(spark, SF_SMALL, "orders")).cache()


def _spec():
    from tabula.plans.preprocess import PrepSpec

    return PrepSpec(id_col="id", cohort_col="cohort", targets=["mean_price"], signal_cols=["sig_a", "sig_b"],
                    boolean_cast_columns=["status"], outlier_columns=["balance", "n_orders"], task="regression")


def test_fit_ignores_test_rows(spark, entities):
    from tabula.plans.preprocess import fit_preprocess

    train = entities.where(F.col("cohort") != "ASIA")
    test_a = entities.where(F.col("cohort") == "ASIA")
    test_b = test_a.withColumn("balance", F.col("balance") * 1000)  # wildly different test rows
    p1 = fit_preprocess(train.unionByName(test_a.limit(0)), _spec())
    p2 = fit_preprocess(train.unionByName(test_b.limit(0)), _spec())
    assert p1["clip"] == p2["clip"] and p1["medians"] == p2["medians"]
    assert {k: v["decision"] for k, v in p1["scalers"].items()} == {k: v["decision"] for k, v in p2["scalers"].items()}


def test_centred_train_cohort_means_equal_global_mean(spark, entities):
    from tabula.plans.preprocess import center_apply, clean_rows, fit_preprocess

    spec = _spec()
    p = fit_preprocess(entities, spec)
    x = clean_rows(entities, spec, p["true_false_columns"])
    from tabula.plans.preprocess import apply_clip_threshold

    x = apply_clip_threshold(x, p, spec)
    c = center_apply(x, p, spec)
    glob = x.agg(F.avg("sig_a")).first()[0]
    for r in c.groupBy("cohort").agg(F.avg("sig_a").alias("m")).collect():
        assert r.m == pytest.approx(glob, abs=1e-9)


def test_apply_keeps_test_uncentred_and_feature_order(spark, entities):
    from tabula.plans.preprocess import apply_preprocess, fit_preprocess

    spec = _spec()
    train = entities.where(F.col("cohort") != "ASIA")
    p = fit_preprocess(train, spec)
    out = apply_preprocess(entities.where(F.col("cohort") == "ASIA"), p, spec, is_train=False)
    assert out.columns == ["id", "cohort", *p["features"], "mean_price"]
    assert out.count() == entities.where(F.col("cohort") == "ASIA").count()


def test_loco_roles_partition_rows(spark, entities):
    from tabula.operators.split import cohort_list, loco_expand

    folds = loco_expand(entities.select("id", "cohort"), "cohort")
    k = len(cohort_list(entities, "cohort"))
    n = entities.count()
    assert folds.count() == n * k
    assert folds.where(F.col("role") == "test").count() == n  # every row is test exactly once
    assert folds.where((F.col("role") == "test") & (F.col("fold") != F.col("cohort"))).count() == 0


def test_stream_scoring_equals_batch(spark, entities):
    """Streaming scoring (per micro-batch) returns the same predictions as batch scoring."""
    from tabula.operators import model as ML
    from tabula.plans.experiment import entity_table
    from tabula.plans.preprocess import apply_preprocess, fit_preprocess
    from tabula.plans.scoring import batch_score
    from tabula.session import load
    from tabula.sources.files import scratch_path
    from tabula.streaming.scoring import read_scores, score_stream

    spec = _spec()
    p = fit_preprocess(entities, spec)
    x = apply_preprocess(entities, p, spec, is_train=True)
    model = ML.selection_pipeline(p["features"], ML.LinearRegression(labelCol="mean_price", solver="normal")).fit(x)
    batch = batch_score(entities.drop("mean_price"), p, spec, model, "exp")
    stream = spark.readStream.schema(load(spark, SF_SMALL, "customer").schema).parquet(f"{SF_SMALL}/customer*.parquet")
    live = entity_table(stream, load(spark, SF_SMALL, "nation"), load(spark, SF_SMALL, "region"),
                         load(spark, SF_SMALL, "orders")).drop("mean_price")
    out = scratch_path(spark, "t-scores")
    score_stream(live, p, spec, model, "exp", out, scratch_path(spark, "t-ckpt")).awaitTermination()
    got = {r.id: r.exp_prediction for r in read_scores(spark, out).collect()}
    want = {r.id: r.exp_prediction for r in batch.collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_loco_quantiles_equal_expanded_form(spark):
    """Per-fold train quantiles without copying rows == quantiles over the explicit LOCO expansion."""
    import random

    from tabula.operators.rank import exact_quantiles
    from tabula.operators.split import loco_quantiles, loco_train

    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        c = ["a", "b", "c", None][i % 4] if i % 3 else "a"  # 'a' is hot, NULL cohort trains everywhere
        v = 0.0 if i % 5 == 0 else rnd.gauss(10, 3)  # a hot repeated value
        rows.append((i, c, v))
    df = spark.createDataFrame(rows, "id long, cohort string, v double")
    got = {r.fold: (r.q1, r.q3) for r in loco_quantiles(df, "cohort", "v", [0.25, 0.75], names=["q1", "q3"]).collect()}
    exp = loco_train(df, "cohort", ["a", "b", "c"])
    want = {r.fold: (r.q1, r.q3) for r in exact_quantiles(exp, ["fold"], "v", [0.25, 0.75], names=["q1", "q3"]).collect()}
    assert got.keys() == want.keys()
    for f in want:
        assert got[f] == pytest.approx(want[f])
