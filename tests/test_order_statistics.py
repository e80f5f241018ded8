"""Order statistics with other bucket numbers, and the small faults mended after the first review."""

import math
import statistics

import pytest

from pyspark.sql import functions as F


def _quantile(xs, p):
    h = (len(xs) - 1) * p
    lo, hi = math.floor(h), math.ceil(h)
    return xs[lo] + (xs[hi] - xs[lo]) * (h - lo)


@pytest.fixture(scope="module")
def values(spark):
    """A smooth group, a heavy-tailed one, one hot value, a constant, an empty one and extreme doubles."""
    rows = [("smooth", math.sin(i) * 10 + i % 7) for i in range(900)]
    rows += [("tail", 1.5 ** (i % 120)) for i in range(400)]
    rows += [("hot", 3.0 if i % 3 else float(i)) for i in range(600)]
    rows += [("one", 5.0)] * 20 + [("none", None)] * 3 + [("none", float("nan"))]
    rows += [("wide", x) for x in (-1.7e308, 1.7e308, 0.0, 1.0, -1.0, 5e-324)] + [(None, 1.0), (None, 2.0)]
    return rows, spark.createDataFrame(rows, "g string, v double").repartition(4)


@pytest.mark.parametrize("buckets,small", [(2, 3), (16, 10), (4096, 10), (4096, 100_000)])
def test_quantiles_and_ks_for_any_bucket_number(values, monkeypatch, buckets, small):
    from tabula.operators import rank

    monkeypatch.setattr(rank, "SMALL", small)
    rows, df = values
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: r for r in rank.exact_quantiles(df, ["g"], "v", probs, buckets=buckets).collect()}
    groups = {g: sorted(v for k, v in rows if k == g and v is not None and not math.isnan(v)) for g, _ in rows}
    assert set(got) == set(groups)
    for g, xs in groups.items():
        for p, q in zip(probs, got[g][1:]):
            assert q is None if not xs else q == pytest.approx(_quantile(xs, p), rel=1e-12), (g, p)
    some = df.where("g in ('smooth', 'tail', 'hot', 'one')")
    ks = {r["g"]: r["ks_stat"] for r in rank.ks_normal_stats(some, ["g"], "v", buckets=buckets).collect()}
    for g in ("smooth", "tail", "hot"):
        xs = groups[g]
        n, m, s = len(xs), statistics.fmean(xs), statistics.stdev(xs)
        cdf = [0.5 * (1 + math.erf((x - m) / s / math.sqrt(2))) for x in xs]
        want = max(max((i + 1) / n - c, c - i / n) for i, c in enumerate(cdf))
        assert ks[g] == pytest.approx(want, abs=1e-6), g
    assert ks["one"] is None


def test_coercion_does_not_depend_on_batches(spark):
    from tabula.operators.encode import coerce_numeric, fit_coercion

    df = spark.createDataFrame([(1, "id 7 x"), (2, "1.253.333.333"), (3, "4.5"), (4, None)], "i int, x string")
    strict = fit_coercion(df, ["x"])
    whole = {r["i"]: r["x"] for r in coerce_numeric(df, ["x"], strict).collect()}
    parts = {r["i"]: r["x"] for i in range(1, 5) for r in coerce_numeric(df.where(F.col("i") == i), ["x"], strict).collect()}
    assert whole == parts == {1: 0.0, 2: 0.0, 3: 4.5, 4: 0.0}


def test_rare_null_is_grouped(spark):
    from tabula.operators.encode import group_rare

    df = spark.createDataFrame([("a",), (None,), ("b",)], "c string")
    rare = spark.createDataFrame([(None,), ("b",)], "__rare string")
    assert sorted(r["c_grouped"] for r in group_rare(df, "c", rare).collect()) == ["a", "rare", "rare"]


def test_dedupe_keeps_any_column_type_and_hashes(spark):
    from tabula.operators.profile import dedupe_first

    df = spark.createDataFrame([(1, 2, {"a": 1}), (1, 1, {"b": 2}), (None, 5, None), (None, 4, {"c": 3})], "id int, seq int, m map<string,int>")
    out = dedupe_first(df, "id", "seq")
    assert sorted((r["id"] or 0, r["seq"], r["m"]) for r in out.collect()) == [(0, 4, {"c": 3}), (1, 1, {"b": 2})]
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_duplicates_need_a_sequence(spark):
    from tabula.plans.preprocess import PrepSpec, dedupe

    with pytest.raises(ValueError):
        dedupe(spark.range(2), PrepSpec(id_col="id", cohort_col="c", targets=["t"], has_duplicates=True))


def test_chi2_leaves_zero_cells_out(spark):
    from tabula.operators.stats import chi2_statistic, crosstab_counts, crosstab_long

    for rows, want in (
        ([("a", "x")] * 10 + [("b", "y")] * 5, (1, 10.8375)),  # a 2x2 table with two zero cells, corrected
        ([("a", "x")] * 10 + [("b", "y")] * 5 + [("c", "x")] * 5, (2, 20.0)),
    ):
        df = spark.createDataFrame(rows, "a string, b string")
        for cells in (crosstab_counts(df, "a", "b"), crosstab_long(df, "a", "b")):
            r = chi2_statistic(cells, "a", "b").first()
            assert (r["dof"], r["statistic"]) == (want[0], pytest.approx(want[1]))
        assert "NestedLoop" not in crosstab_long(df, "a", "b")._jdf.queryExecution().executedPlan().toString()


def test_prefix_resolution():
    from tabula.operators.relational import resolve_by_prefix

    cols = ["a", "a_x", "b_x_y", "b_z", "c"]
    assert resolve_by_prefix(cols, ["b", "a", "b_x", "d", "a"]) == ["b_x_y", "b_z", "a"]


def test_scratch_folder_is_refused_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from tabula.session import ensure_checkpoint_dir

    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(fake)


def test_stored_fit_scores_as_the_fitted_one_in_any_batches(spark, tmp_path):
    from tabula.catalog.models import entities, spec_for
    from tabula.operators import model as ML
    from tabula.plans.preprocess import apply_preprocess, fit_preprocess
    from tabula.plans.scoring import batch_score, batch_score_targets, load_best_run, save_run

    from .conftest import SF_SMALL

    df, spec = entities(spark, SF_SMALL).cache(), spec_for("regression")
    params = fit_preprocess(df, spec)
    x = apply_preprocess(df, params, spec, is_train=True)
    model = ML.selection_pipeline(params["features"], ML.LinearRegression(labelCol="mean_price", solver="normal")).fit(x)
    for k, r2 in enumerate((0.1, 0.7, 0.3)):
        run = {"run_id": f"r{k}", "experiment_id": "e", "start_time": k, "metrics": {"r2": r2}}
        save_run(spark, str(tmp_path), run, params if k == 1 else {"features": []}, [model] if k == 1 else [])
    got, models = load_best_run(spark, str(tmp_path), "e", ["r2"])
    new = df.unionByName(df.where("id % 10 = 0"))  # repeated ids are scored too
    want = sorted(map(tuple, batch_score(new, params, spec, model, "e").collect()))
    assert sorted(map(tuple, batch_score_targets(new, got, spec, models, "e").collect())) == want
    parts = [r for b in range(3) for r in batch_score_targets(new.where(F.col("id") % 3 == b), got, spec, models, "e").collect()]
    assert sorted(map(tuple, parts)) == want and len(want) == new.count()
    two = batch_score_targets(new, got, spec, [models[0], models[0]], "e")
    assert two.columns == ["id", "e_prediction_0", "e_prediction_1"]
