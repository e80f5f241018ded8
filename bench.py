"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed completely through the ``noop`` sink (no collect), timed,
and the total is printed as ONE JSON line:
{"metric": "headline_total", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "loco_clip_scale_profile",
    "iqr_profile",
    "moments_profile",
    "ks_normal",
    "boxplot_stats",
    "correlation_matrix",
    "mutual_information",
    "qcut_values",
    "choose_scaler",
    "apply_params_join",
    "rank_first",
    "qcut_rank_bins",
    "stratified_kfold",
    "dedupe_first",
    "crosstab",
    "chi2_test",
    "bias_profile",
    "group_rare",
    "impute",
    "coerce_numeric_fallback",
    "classification_metrics",
    "multilabel_metrics",
    "regression_metrics",
    "run_lineage",
    "map_flatten",
    "best_run_per_experiment",
    "qc_recommendations",
    "expression_matrix",
    "top_variance_features",
    "kde_curve",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tabula.catalog import QUERIES
    from tabula.session import get_spark

    spark = get_spark(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    # untimed warm-up on the smallest scale: JVM JIT, codegen and Python imports
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for n in names if os.path.isdir(warm_dir) else []:
        QUERIES[n](spark, warm_dir).write.mode("overwrite").format("noop").save()
    times: dict[str, float] = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.mode("overwrite").format("noop").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    try:
        sf_val: float | str = float(sf)
    except ValueError:
        sf_val = sf
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf_val}))


if __name__ == "__main__":
    main()
