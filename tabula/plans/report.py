"""Run-table evaluation report (O-105): the notebook's analysis as one DataFrame job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.relational import filter_null_safe_metadata
from ..operators.runlog import FINISHED, clean_run_table


def eval_report(flat: DataFrame, model_col: str, metric_cols: Sequence[str], flag: str | None = None,
                flag_value: str = "TRUE", group: str = "experiment_id") -> DataFrame:
    """Per (experiment, selected model): rows kept, mean of each metric, and the best model.

    Steps: drop flagged runs (flag != 'TRUE', NULL kept), finished runs only,
    keep (group, model, metrics), distinct, drop rows with NULLs (O-16, O-19),
    then per-group means (O-46) with the best model by the first metric.
    """
    f = flat
    if flag is not None and flag in f.columns:
        f = filter_null_safe_metadata(f, flag, flag_value, [])
    if "status" in f.columns:
        f = f.where(F.col("status") == FINISHED)
    c = clean_run_table(f, [group, model_col, *metric_cols])
    g = c.groupBy(F.col(f"`{group}`"), F.col(f"`{model_col}`")).agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        *[F.avg(f"`{m}`").alias(f"mean_{m.split('.', 1)[-1]}") for m in metric_cols],
    )
    first = f"mean_{metric_cols[0].split('.', 1)[-1]}"
    best = g.groupBy(F.col(f"`{group}`")).agg(F.max_by(F.col(f"`{model_col}`"), F.col(first)).alias("__best"))
    return g.join(best, group).withColumn("is_best", F.col(f"`{model_col}`") == F.col("__best")).drop("__best")
