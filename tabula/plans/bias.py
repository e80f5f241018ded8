"""Bias profile (O-47): for every target × bias column, a crosstab and a χ² test in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import cut_bins
from ..operators.stats import chi2_statistic, chi2_sf

# Age bins (left-closed) and their labels.
AGE_EDGES = [0, 40, 50, 60, 70, 80, 100]
AGE_LABELS = ["0-39", "40-49", "50-59", "60-69", "70-79", "80+"]


def age_group(c: str):
    """O-62 with the age bins: [0,40) … [80,100); outside → NULL."""
    return cut_bins(c, AGE_EDGES, AGE_LABELS)


def bias_long(df: DataFrame, targets: Sequence[str], bias_cols: Sequence[str]) -> DataFrame:
    """(target, bias_column, t, b) per row and pair; a fixed-width explode over the column lists."""
    pairs = [
        F.struct(F.lit(t).alias("target"), F.lit(b).alias("bias_column"),
                 F.col(f"`{t}`").cast("string").alias("t"), F.col(f"`{b}`").cast("string").alias("b"))
        for t in targets for b in bias_cols
    ]
    return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def bias_profile(df: DataFrame, targets: Sequence[str], bias_cols: Sequence[str], with_p: bool = True) -> DataFrame:
    """O-47: one row per (target, bias column): χ² statistic, dof (and p-value).

    Non-zero cell counts of all pairs come from one aggregation; zero cells follow from the marginals.
    """
    long = bias_long(df, targets, bias_cols).where(F.col("t").isNotNull() & F.col("b").isNotNull())
    keys = ["target", "bias_column"]
    counts = long.groupBy(*keys, "t", "b").agg(F.count(F.lit(1)).cast("long").alias("n"))
    out = chi2_statistic(counts, "t", "b", keys)
    return out.withColumn("p_value", chi2_sf(F.col("statistic"), F.col("dof"))) if with_p else out
