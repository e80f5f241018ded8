"""Fitted parameters and their application (O-22, O-23, O-51, O-68, O-69, O-83..O-88).

Parameters live in small long tables keyed by (fold, column): their size is
bounded by #folds × #columns, independent of the row count, so attaching them
to rows is a broadcast equi-join (or literals in one ``select`` once collected).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import kolmogorov_p, normal_cdf
from .profile import kurtosis_g2, melt
from .rank import distribution_profile, exact_quantiles

# Scaler decision names and thresholds of the decision rule.
NO_SCALING = "NoScaling"
SIGNAL = "GeneExpression"
LOG1P = "Log1pTransform"
MINMAX = "MinMaxScaler"
STANDARD = "StandardScaler"
ROBUST = "RobustScaler"
KS_P_MIN, KS_D_MAX, KURT_STANDARD, KURT_ROBUST, ZERO_RATIO_LOG = 0.05, 0.08, 1.0, 3.0, 0.5


# ------------------------------------------------------------ IQR clipping
def fit_iqr_bounds(long: DataFrame, keys: Sequence[str] = (), k: float = 1.5) -> DataFrame:
    """O-69 fit on train rows: (keys, column, q1, q3, lower, upper)."""
    q = exact_quantiles(long, [*keys, "column"], "value", [0.25, 0.75], names=["q1", "q3"])
    iqr = F.col("q3") - F.col("q1")
    return q.withColumn("lower", F.col("q1") - k * iqr).withColumn("upper", F.col("q3") + k * iqr)


def iqr_clip_expr(x: Column, q1: Column, q3: Column, lower: Column, upper: Column) -> Column:
    """Below the lower fence → Q1, above the upper fence → Q3 (not the fence); NULL kept."""
    return F.when(x < lower, q1).when(x > upper, q3).otherwise(x)


def iqr_clip_long(long: DataFrame, bounds: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """O-69 apply in long layout (bounds broadcast: one row per (keys, column))."""
    j = long.join(F.broadcast(bounds.select(*keys, "column", "q1", "q3", "lower", "upper")), [*keys, "column"], "left")
    return j.withColumn(
        "value", iqr_clip_expr(F.col("value"), F.col("q1"), F.col("q3"), F.col("lower"), F.col("upper"))
    ).drop("q1", "q3", "lower", "upper")


# -------------------------------------------------------------- centring
def fit_group_offsets(long: DataFrame, group: str, keys: Sequence[str] = ()) -> DataFrame:
    """O-23/O-51 fit: offset = group mean − global mean per (keys, group, column).

    Two mergeable aggregations (per group and global), not a window: a hot group
    is partially aggregated in every task. NULL group is a group of its own.
    """
    g = long.groupBy(*keys, group, "column").agg(F.avg("value").alias("__gm"))
    a = long.groupBy(*keys, "column").agg(F.avg("value").alias("__am"))
    return g.join(a, [*keys, "column"]).select(*keys, group, "column", (F.col("__gm") - F.col("__am")).alias("offset"))


def apply_group_offsets(long: DataFrame, offsets: DataFrame, group: str, keys: Sequence[str] = ()) -> DataFrame:
    """O-23 apply: value − offset of the row's group (NULL-safe group match)."""
    o = offsets.select(*[F.col(k).alias(f"__o_{k}") for k in [*keys, group, "column"]], "offset")
    cond = None
    for k in [*keys, group, "column"]:
        c = long[k].eqNullSafe(o[f"__o_{k}"])
        cond = c if cond is None else cond & c
    j = long.join(F.broadcast(o), cond, "left")
    return j.withColumn("value", F.col("value") - F.coalesce(F.col("offset"), F.lit(0.0))).select(*long.columns)


def group_center(long: DataFrame, group: str, role: str = "role", keys: Sequence[str] = ()) -> DataFrame:
    """O-51: centre train rows by their group's offset; test rows untouched."""
    train = long.where(F.col(role) == "train")
    offsets = fit_group_offsets(train, group, keys)
    centred = apply_group_offsets(train, offsets, group, keys)
    return centred.unionByName(long.where(F.col(role) != "train"))


# ------------------------------------------------------------- thresholds
def threshold_long(long: DataFrame, t: float = 1.5) -> DataFrame:
    """O-68 in long layout: abs(x) ≤ t → 0."""
    return long.withColumn("value", F.when(F.abs(F.col("value")) > t, F.col("value")).otherwise(F.lit(0.0)))


# --------------------------------------------------------- scaler choice
def scaler_stats(long: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per (keys, column): n, mean, std, min, max, zero ratio, G2 kurtosis, KS D and p, Q1/median/Q3.

    Three passes over the long layout (see ``distribution_profile``); no sort of
    the table. An all-NULL column keeps its row with n = 0.
    """
    d = distribution_profile(long, [*keys, "column"], "value", [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    d = d.withColumn("kurtosis", kurtosis_g2(F.col("n"), F.col("kurt_pop"))).drop("kurt_pop")
    return d.withColumn("ks_p", F.when(F.col("ks_stat").isNotNull(), kolmogorov_p(F.col("ks_stat"), F.col("n"))))


def decision_expr(signal_cols: Sequence[str] = ()) -> Column:
    """O-83 decision rule, in the reference's order, over :func:`scaler_stats` columns."""
    k = F.abs(F.col("kurtosis"))
    d, p = F.col("ks_stat"), F.col("ks_p")
    sig = F.col("column").isin(list(signal_cols)) if signal_cols else F.lit(False)
    return (
        F.when(sig, F.lit(SIGNAL))
        .when(F.coalesce(F.col("n"), F.lit(0)) == 0, F.lit(NO_SCALING))
        .when(F.col("std").isNull() | (F.col("std") == 0), F.lit(NO_SCALING))
        .when((F.col("zero_ratio") >= ZERO_RATIO_LOG) & (F.col("min") >= 0), F.lit(LOG1P))
        .when((F.col("min") >= 0) & (F.col("max") <= 1), F.lit(MINMAX))
        .when((p >= KS_P_MIN) & (d <= KS_D_MAX) & (k <= KURT_STANDARD), F.lit(STANDARD))
        .when((p < KS_P_MIN) | (d > KS_D_MAX) | (k > KURT_ROBUST), F.lit(ROBUST))
        .otherwise(F.lit(STANDARD))
    )


def choose_scaler(long: DataFrame, keys: Sequence[str] = (), signal_cols: Sequence[str] = ()) -> DataFrame:
    """O-83: decision per (keys, column) plus every parameter a transform needs."""
    st = scaler_stats(long, keys)
    return st.withColumn("decision", decision_expr(signal_cols)).withColumn("iqr", F.col("q3") - F.col("q1"))


def transform_expr(x: Column, decision: Column, p: dict[str, Column]) -> Column:
    """O-84..O-87 as one expression over a row's fitted parameters."""
    return (
        F.when(decision == LOG1P, F.log1p(x))
        .when((decision == MINMAX) & (p["max"] > p["min"]), (x - p["min"]) / (p["max"] - p["min"]))
        .when((decision == STANDARD) & (p["std"] > 0), (x - p["mean"]) / p["std"])
        .when((decision == ROBUST) & (p["iqr"] > 0), (x - p["median"]) / p["iqr"])
        .otherwise(x)
    )


def fit_transform(long: DataFrame, decision: str, keys: Sequence[str] = ()) -> DataFrame:
    """Parameters of one fixed transform per (keys, column): only what it needs is computed, the rest is NULL."""
    by = [*keys, "column"]
    if decision == ROBUST:
        st = exact_quantiles(long, by, "value", [0.25, 0.5, 0.75], names=["q1", "median", "q3"])
        st = st.withColumn("iqr", F.col("q3") - F.col("q1"))
    else:
        v = F.when(~F.isnan("value"), F.col("value"))
        agg = {MINMAX: [F.min(v).alias("min"), F.max(v).alias("max")],
               STANDARD: [F.avg(v).alias("mean"), F.stddev_samp(v).alias("std")]}.get(decision)
        st = long.groupBy(*by).agg(*agg) if agg else long.select(*by).distinct()
    cols = ["min", "max", "mean", "std", "median", "iqr"]
    return st.select(*by, F.lit(decision).alias("decision"),
                     *[F.col(c) if c in st.columns else F.lit(None).cast("double").alias(c) for c in cols])


def apply_params_long(long: DataFrame, params: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """O-22: apply fitted per-column transforms in long layout (broadcast params join)."""
    cols = ["decision", "min", "max", "mean", "std", "median", "iqr"]
    j = long.join(F.broadcast(params.select(*keys, "column", *cols)), [*keys, "column"], "left")
    p = {c: F.col(c) for c in cols}
    return j.withColumn("value", transform_expr(F.col("value"), F.coalesce(F.col("decision"), F.lit(NO_SCALING)), p)).drop(*cols)


def apply_transform_wide(df: DataFrame, params: list[dict]) -> DataFrame:
    """Apply collected per-column params as literals in one ``select`` (codegen-friendly)."""
    by_col = {p["column"]: p for p in params}
    exprs = []
    for c in df.columns:
        if c in by_col:
            p = by_col[c]
            lit = {k: F.lit(p.get(k)).cast("double") for k in ["min", "max", "mean", "std", "median", "iqr"]}
            exprs.append(transform_expr(F.col(f"`{c}`").cast("double"), F.lit(p["decision"]), lit).alias(c))
        else:
            exprs.append(F.col(f"`{c}`"))
    return df.select(*exprs)


# ------------------------------------------------------ variance selection
def variance_select(long: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """O-88: columns whose population variance is > 0 (per fold when keys given)."""
    v = long.groupBy(*keys, "column").agg(F.var_pop("value").alias("variance"))
    return v.withColumn("selected", F.coalesce(F.col("variance") > 0, F.lit(False)))


__all__ = [
    "fit_iqr_bounds", "iqr_clip_long", "fit_group_offsets", "apply_group_offsets", "group_center", "threshold_long",
    "scaler_stats", "choose_scaler", "transform_expr", "apply_params_long", "apply_transform_wide", "variance_select",
    "melt",
]
