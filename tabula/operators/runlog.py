"""Run-log operators (O-05, O-06, O-25, O-46, O-58, O-80, O-105).

A run table has one row per run: run_id, run_name, experiment_id, status,
start_time (epoch ms), parent_run_id, metrics map<string,double>,
params map<string,string>, tags map<string,string>. It is an ordinary
(partitioned) Parquet table, so every operator is a DataFrame query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINISHED = "FINISHED"
# Map keys are turned into columns; more distinct keys than this is not a run log.
MAX_MAP_KEYS = 10_000


def run_log_scan(runs: DataFrame, experiment: str | None = None, only_finished: bool = True,
                 max_results: int | None = None) -> DataFrame:
    """O-05: runs of one or all experiments, optionally finished only, newest first, optionally capped."""
    out = runs
    if experiment is not None:
        out = out.where(F.col("experiment_id") == experiment)
    if only_finished:
        out = out.where(F.col("status") == FINISHED)
    out = out.orderBy(F.col("start_time").desc(), F.col("run_id"))
    return out.limit(max_results) if max_results else out


def run_log_append(summary: DataFrame, path: str, partition_by: Sequence[str] = ("experiment_id",)) -> None:
    """O-06: append run summary rows to a Parquet run table partitioned by experiment."""
    summary.write.mode("append").partitionBy(*partition_by).parquet(path)


def run_log_replace(summary: DataFrame, path: str) -> None:
    """O-06: put run summary rows into a run table so that a repeated write has the effect of one.

    The table has a partition per run; the written runs' partitions are replaced and all others stay, so a retried
    step or a repeated experiment leaves each run once. Rows must not repeat a run id.
    """
    writer = summary.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("experiment_id", "run_id").parquet(path)


def run_lineage(runs: DataFrame) -> DataFrame:
    """O-25: child count per run and is_parent / is_child flags.

    Children are counted with one aggregation by parent id (no child lists are
    gathered: a parent with millions of children is one counter). The edge list
    itself is :func:`run_edges`.
    """
    kids = runs.where(F.col("parent_run_id").isNotNull()).groupBy("parent_run_id").agg(
        F.count(F.lit(1)).cast("long").alias("child_run_count")
    ).withColumnRenamed("parent_run_id", "__pid")
    j = runs.join(kids, runs["run_id"] == kids["__pid"], "left")
    n = F.coalesce(F.col("child_run_count"), F.lit(0)).cast("long")
    return j.select(
        "run_id", "parent_run_id", n.alias("child_run_count"),
        F.col("parent_run_id").isNotNull().alias("is_child_run"), (n > 0).alias("is_parent_run"),
    )


def run_edges(runs: DataFrame) -> DataFrame:
    """(parent_run_id, child_run_id) pairs: the scalable form of the child-id lists."""
    return runs.where(F.col("parent_run_id").isNotNull()).select("parent_run_id", F.col("run_id").alias("child_run_id"))


def map_keys_of(runs: DataFrame, col: str, max_keys: int = MAX_MAP_KEYS) -> list[str]:
    keys = [r[0] for r in runs.select(F.explode(F.map_keys(col))).distinct().orderBy(1).limit(max_keys + 1).collect()]
    if len(keys) > max_keys:
        raise ValueError(f"more than {max_keys} keys in {col}")
    return keys


def map_flatten(runs: DataFrame, base: Sequence[str] = ("run_id",)) -> DataFrame:
    """O-80: metrics/params/tags maps → ``metric.k`` / ``param.k`` / ``tag.k`` columns.

    The distinct key list (small) is read once; the flattening is then a narrow
    ``element_at`` projection, with no shuffle.
    """
    cols: list[Column] = [F.col(c) for c in base]
    for m, prefix in (("metrics", "metric"), ("params", "param"), ("tags", "tag")):
        if m in runs.columns:
            for k in map_keys_of(runs, m):
                cols.append(F.element_at(F.col(m), F.lit(k)).alias(f"{prefix}.{k}"))
    return runs.select(*cols)


def map_entries(runs: DataFrame, base: Sequence[str] = ("run_id",)) -> DataFrame:
    """O-80 in long form: (base..., kind, key, number, text) with a row per entry of the metrics (number), params and
    tags (text) maps.

    A narrow explode without a list of keys, so any number of keys is fine. Runs without entries, and NULL maps, have
    no rows; a NULL value stays a row.
    """
    item = "struct<kind:string,key:string,number:double,text:string>"

    def entries(m: str, kind: str) -> Column:
        number = kind == "metric"
        each = F.transform(F.map_entries(m), lambda e: F.struct(
            F.lit(kind), e["key"], e["value"] if number else F.lit(None), F.lit(None) if number else e["value"]
        ).cast(item))
        return F.coalesce(each, F.array().cast(f"array<{item}>"))

    kinds = [(m, k) for m, k in (("metrics", "metric"), ("params", "param"), ("tags", "tag")) if m in runs.columns]
    found = F.explode(F.concat(*[entries(m, k) for m, k in kinds]))
    return runs.select(*base, found.alias("e")).select(*base, "e.*")


def map_columns(runs: DataFrame, wanted: Sequence[str], base: Sequence[str] = ("run_id",)) -> DataFrame:
    """O-80 for the columns that are wanted: ``metric.k``, ``param.k`` and ``tag.k`` by name, NULL where a run lacks
    the key. One projection; no keys are read beforehand."""
    maps = {"metric": "metrics", "param": "params", "tag": "tags"}
    cols = []
    for name in wanted:
        kind, key = name.split(".", 1)
        cols.append(F.element_at(F.col(maps[kind]), F.lit(key)).alias(name))
    return runs.select(*base, *cols)


def best_run(runs: DataFrame, metric_priority: Sequence[str], with_model: DataFrame | None = None,
             keys: Sequence[str] = ()) -> DataFrame:
    """O-58: best run by the first present metric in priority order (−inf if none).

    Order: score desc, start_time desc, run_id. Runs without a model (anti to
    ``with_model``) are excluded. ``max`` of a struct is a mergeable aggregate,
    so per-experiment bests need no sort of the whole table.
    """
    score = F.coalesce(*[F.element_at(F.col("metrics"), F.lit(m)) for m in metric_priority], F.lit(float("-inf")))
    r = runs
    if with_model is not None:
        r = r.join(with_model.select("run_id").distinct(), "run_id", "left_semi")
    r = r.select(*keys, "run_id", score.alias("score"), F.coalesce(F.col("start_time"), F.lit(0)).alias("__st"))
    # min over (−score, −start, run_id) = highest score, then newest, then smallest id.
    best = r.groupBy(*keys).agg(
        F.min(F.struct((-F.col("score")).alias("ns"), (-F.col("__st")).alias("nst"), F.col("run_id"))).alias("__b")
    )
    return best.select(*keys, F.col("__b.run_id").alias("run_id"), (-F.col("__b.ns")).alias("score"))


def clean_run_table(flat: DataFrame, keep: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """O-105 step: keep metadata + metric columns, drop some, distinct rows, drop rows with NULLs."""
    cols = [c for c in keep if c in flat.columns and c not in drop]
    from .relational import drop_any_null

    return drop_any_null(flat.select(*[F.col(f"`{c}`") for c in cols]).distinct())
