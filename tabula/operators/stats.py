"""Statistical exploration operators (O-36, O-37, O-39..O-44, O-46, O-50).

All of them aggregate in long layout with mergeable (partial) aggregates; where
an order is needed (KS, quantile edges) it comes from the skew-safe ranks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import kolmogorov_p, normal_cdf
from ..session import stored
from .profile import melt
from .rank import exact_quantiles, ks_normal_stats, row_number_by


def _one(df: DataFrame) -> DataFrame:
    return df.withColumn("__one", F.lit(1))


# ---------------------------------------------------------------- crosstab/χ²
def crosstab_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Non-zero cells (a, b, n); rows with a NULL in either are dropped."""
    pairs = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return pairs.groupBy(a, b).agg(F.count(F.lit(1)).cast("long").alias("n"))


#: The dense crosstab has a row per cell; more levels on its short side than this are refused (use the counts).
MAX_LEVELS = 10_000


def crosstab_long(df: DataFrame, a: str, b: str) -> DataFrame:
    """O-36: counts per (a, b) including zero cells, long (a, b, n).

    Each level of ``a`` is exploded over the list of levels of ``b``, which is checked to be short.
    """
    counts = crosstab_counts(df, a, b)
    levels = [r[0] for r in counts.select(b).distinct().limit(MAX_LEVELS + 1).collect()]
    if len(levels) > MAX_LEVELS:
        raise ValueError(f"{b} has more than {MAX_LEVELS} levels for a dense crosstab")
    kind = counts.schema[b].dataType
    listed = F.array(*[F.lit(x).cast(kind) for x in levels]) if levels else F.array().cast(f"array<{kind.simpleString()}>")
    grid = counts.select(a).distinct().withColumn(b, F.explode(listed))
    return grid.join(counts, [a, b], "left").withColumn("n", F.coalesce(F.col("n"), F.lit(0)).cast("long"))


def chi2_statistic(ct: DataFrame, a: str, b: str, keys: Sequence[str] = ()) -> DataFrame:
    """O-37: χ² independence statistic and dof from the cells of a crosstab (zero cells may be left out).

    E = row·col/total. A zero cell contributes its expectation, and all expectations sum to the total, so zero cells
    add the total less the expectations of the others. With dof = 1 (a 2×2 table) Yates' correction applies: there
    |n − E| is the same in all four cells, and 1/E sums to total · Σ1/row · Σ1/col.
    ``keys`` lets many tables (e.g. per target × bias column) run in one job.
    """
    keys = list(keys) or ["__one"]
    ct = (ct if "__one" not in keys else _one(ct)).where("n > 0")
    rows = ct.groupBy(*keys, a).agg(F.sum("n").alias("__r"))
    cols = ct.groupBy(*keys, b).agg(F.sum("n").alias("__c"))
    sides = rows.groupBy(*keys).agg(F.sum("__r").alias("__t"), F.count(F.lit(1)).alias("__na"), F.sum(1 / F.col("__r")).alias("__ir"))
    sides = sides.join(cols.groupBy(*keys).agg(F.count(F.lit(1)).alias("__nb"), F.sum(1 / F.col("__c")).alias("__ic")), keys)
    j = ct.join(rows, [*keys, a]).join(cols, [*keys, b]).join(sides, keys)
    e = F.col("__r") * F.col("__c") / F.col("__t")
    j = j.withColumn("__e", e).withColumn("__d", F.abs(F.col("n") - e))
    out = j.groupBy(*keys).agg(
        F.sum(F.pow("__d", F.lit(2)) / F.col("__e")).alias("__x"), F.sum("__e").alias("__es"), F.max("__d").alias("__dm"),
        *[F.first(c).alias(c) for c in ("__t", "__na", "__nb", "__ir", "__ic")],
    )
    dof = ((F.col("__na") - 1) * (F.col("__nb") - 1)).cast("long")
    yates = F.pow(F.col("__dm") - F.least(F.lit(0.5), F.col("__dm")), F.lit(2)) * F.col("__t") * F.col("__ir") * F.col("__ic")
    plain = F.col("__x") + F.greatest(F.col("__t") - F.col("__es"), F.lit(0.0))
    return out.select(*keys, F.when(dof == 1, yates).otherwise(plain).alias("statistic"), dof.alias("dof")).drop("__one")


def _gamma_q(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x) (series / continued fraction)."""
    if x is None or a is None or (isinstance(x, float) and math.isnan(x)):
        return float("nan")
    if x <= 0:
        return 1.0
    gln = math.lgamma(a)
    if x < a + 1:
        ap, s, d = a, 1.0 / a, 1.0 / a
        for _ in range(10000):
            ap += 1
            d *= x / ap
            s += d
            if abs(d) < abs(s) * 1e-15:
                break
        return max(0.0, 1.0 - s * math.exp(-x + a * math.log(x) - gln))
    b = x + 1 - a
    c = 1.0 / 1e-300
    d = 1.0 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        de = d * c
        h *= de
        if abs(de - 1) < 1e-15:
            break
    return min(1.0, math.exp(-x + a * math.log(x) - gln) * h)


def _chi2_sf_batch(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """Survival function of χ²(dof); a small helper applied to result rows only."""
    return pd.Series(
        [_gamma_q(float(k) / 2.0, float(s) / 2.0) if k and k > 0 and s == s else float("nan") for s, k in zip(stat, dof)]
    )


def chi2_sf(stat: Column, dof: Column) -> Column:
    return F.pandas_udf(_chi2_sf_batch, "double")(stat, dof)


def chi2_test(ct: DataFrame, a: str, b: str, keys: Sequence[str] = ()) -> DataFrame:
    """O-37 with the p-value (statistic, dof, p)."""
    return chi2_statistic(ct, a, b, keys).withColumn("p_value", chi2_sf(F.col("statistic"), F.col("dof")))


# ------------------------------------------------------------------------ KS
def ks_normal(df: DataFrame, id_col: str, cols: Sequence[str]) -> DataFrame:
    """O-39: one-sample KS statistic and asymptotic p against N(mean, std) per column.

    D = max(i/n − F(x_i), F(x_i) − (i−1)/n) over the sorted sample, computed per
    column from value buckets (no sort of the table, see ``ks_normal_stats``).
    """
    long = melt(df, [id_col], cols)
    d = ks_normal_stats(long, ["column"], "value")
    return d.select("column", "ks_stat", "n").withColumn("ks_p", kolmogorov_p(F.col("ks_stat"), F.col("n")))


# --------------------------------------------------------------- correlation
def pair_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy) for i < j: moments of the rows in which columns i and j are both present.

    Tasks add up masked Gramians (0 where a value is missing) and emit their upper triangles once, so the shuffle is
    tasks x columns² numbers whatever the number of rows. Values are taken from the column's mean, so that sums of
    squares of far-off columns don't cancel. A task holds six times columns² doubles.
    """
    cols = list(cols)
    x = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    means = x.agg(*[F.avg(c).alias(c) for c in x.columns]).first()
    shift = np.array([0.0 if m is None or m != m else m for m in means])

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        d = len(shift)
        n, sx, sxx, sxy = (np.zeros((d, d)) for _ in range(4))
        for pdf in batches:
            v = pdf.to_numpy(dtype=float) - shift
            there = ~np.isnan(v)
            v, m = np.where(there, v, 0.0), there.astype(float)
            n += m.T @ m
            sx += v.T @ m
            sxx += (v * v).T @ m
            sxy += v.T @ v
        for i in range(d - 1):
            k = slice(i + 1, d)
            yield pd.DataFrame({
                "i": i, "j": np.arange(i + 1, d), "n": n[i, k], "sx": sx[i, k], "sy": sx[k, i], "sxx": sxx[i, k], "syy": sxx[k, i], "sxy": sxy[i, k],
            })

    names = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    each = x.mapInPandas(sums, "i int, j int, " + ", ".join(f"{c} double" for c in names))
    return each.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in names])


def correlation_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """O-40: pairwise-complete Pearson matrix in long form (col_a, col_b, corr), any width, with or without NULLs.

    One pass of ``pair_moments``. A pair without variance in one of its columns (up to rounding: 1e-13 of the sum of
    squares) has no correlation. Columns with a non-finite correlation anywhere are removed, as in the reference.
    """
    cols = list(cols)
    spark = df.sparkSession
    if len(cols) < 2:
        return spark.createDataFrame([], "col_a string, col_b string, corr double")

    def spread(sq: str, s: str) -> Column:
        v = F.col("n") * F.col(sq) - F.col(s) * F.col(s)
        return F.when(v > F.lit(1e-13) * F.col("n") * F.col(sq), v)

    names = F.array(*[F.lit(c) for c in cols])
    cov = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    corr = cov / F.sqrt(spread("sxx", "sx")) / F.sqrt(spread("syy", "sy"))
    upper = stored(pair_moments(df, cols).select(
        F.element_at(names, F.col("i") + 1).alias("col_a"), F.element_at(names, F.col("j") + 1).alias("col_b"),
        F.when(corr > 1, 1.0).when(corr < -1, -1.0).otherwise(corr).alias("corr"),
    ), "correlation")
    sym = upper.unionByName(upper.select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr"))
    diag = spark.createDataFrame([(c, c, 1.0) for c in cols], "col_a string, col_b string, corr double")
    full = sym.unionByName(diag)
    finite = F.col("corr").isNotNull() & ~F.isnan("corr")
    bad = full.where(~finite).select(F.col("col_a").alias("__bad")).distinct()
    keep = full.join(bad, full["col_a"] == bad["__bad"], "left_anti")
    return keep.join(bad, keep["col_b"] == bad["__bad"], "left_anti")


def target_correlation_rank(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """O-41: correlation of each feature with the target, descending rank."""
    wide = df.agg(*[F.corr(F.col(f"`{c}`").cast("double"), F.col(target).cast("double")).alias(c) for c in features])
    long = wide.unpivot([], list(features), "feature", "corr").where(F.col("corr").isNotNull() & ~F.isnan("corr"))
    w = Window.orderBy(F.col("corr").desc(), F.col("feature"))  # over ≤ #features rows
    return long.withColumn("rank", F.row_number().over(w).cast("long"))


def top_variance_features(long: DataFrame, k: int = 50, feature: str = "feature", value: str = "value") -> DataFrame:
    """O-42: the k features with the highest sample variance (ties by name)."""
    v = long.groupBy(feature).agg(F.var_samp(value).alias("variance"))
    w = Window.orderBy(F.col("variance").desc_nulls_last(), F.col(feature))  # over #features rows
    return v.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


# ----------------------------------------------------------- quantile bins
def qcut_edges(long: DataFrame, q: int, keys: Sequence[str] = ("column",), value: str = "value") -> DataFrame:
    """Quantile edges 0, 1/q, …, 1 per group as an array of distinct sorted edges."""
    probs = [i / q for i in range(q + 1)]
    names = [f"__e{i}" for i in range(q + 1)]
    e = exact_quantiles(long, list(keys), value, probs, names=names)
    return e.select(*keys, F.array_sort(F.array_distinct(F.array(*names))).alias("edges"))


def qcut_label(value: Column, edges: Column) -> Column:
    """O-50 label: max(0, #{edges < x} − 1) (right-closed bins, lowest edge included); NULL kept."""
    cnt = F.size(F.filter(edges, lambda e: e < value))
    return F.when(value.isNull(), F.lit(None).cast("long")).otherwise(F.greatest(cnt - 1, F.lit(0)).cast("long"))


def qcut_values(df: DataFrame, id_col: str, cols: Sequence[str], q: int = 4, keep: Sequence[str] = ()) -> DataFrame:
    """O-50: q value-quantile bins per column with duplicate edges dropped (long output)."""
    ids = [id_col, *[k for k in keep if k != id_col]]
    long = melt(df, ids, cols)
    edges = qcut_edges(long.where(F.col("value").isNotNull()), q)
    j = long.join(F.broadcast(edges), "column")
    return j.select(*ids, "column", qcut_label(F.col("value"), F.col("edges")).alias("bin"))


def mutual_information(long: DataFrame, target: str, id_col: str, bins: int = 10, target_bins: int | None = None,
                       feature: str = "feature", value: str = "value") -> DataFrame:
    """O-43 (re-aimed): plug-in MI (nats) between quantile-binned features and the target.

    ``long`` is (id, feature, value, target). Feature values are binned by O-50
    with ``bins`` edges; a numeric target is binned the same way when
    ``target_bins`` is given. MI = Σ p(x,y) ln(p(x,y) / (p(x)p(y))) over non-empty
    cells, from joint counts (one groupBy), ranked descending, ties by name.
    """
    data = long.where(F.col(target).isNotNull()).withColumn(value, F.coalesce(F.col(value).cast("double"), F.lit(0.0)))
    edges = qcut_edges(data.select(feature, value, id_col), bins, keys=[feature], value=value)
    x = data.join(F.broadcast(edges), feature).withColumn("__x", qcut_label(F.col(value), F.col("edges")))
    if target_bins:
        ty = data.select(id_col, F.lit("__t").alias("__f"), F.col(target).cast("double").alias("__y")).distinct()
        te = qcut_edges(ty, target_bins, keys=["__f"], value="__y")
        ty = ty.join(F.broadcast(te), "__f").select(id_col, qcut_label(F.col("__y"), F.col("edges")).cast("string").alias("__y"))
        x = x.drop("edges").join(ty, id_col)
    else:
        x = x.drop("edges").withColumn("__y", F.col(target).cast("string"))
    joint = x.groupBy(feature, "__x", "__y").agg(F.count(F.lit(1)).alias("__nxy"))
    px = joint.groupBy(feature, "__x").agg(F.sum("__nxy").alias("__nx"))
    py = joint.groupBy(feature, "__y").agg(F.sum("__nxy").alias("__ny"))
    n = joint.groupBy(feature).agg(F.sum("__nxy").alias("__n"))
    j = joint.join(px, [feature, "__x"]).join(py, [feature, "__y"]).join(n, feature)
    term = (F.col("__nxy") / F.col("__n")) * F.log(
        (F.col("__nxy") * F.col("__n")) / (F.col("__nx") * F.col("__ny"))
    )
    mi = j.groupBy(feature).agg(F.sum(term).alias("mi"))
    w = Window.orderBy(F.col("mi").desc(), F.col(feature))  # over #features rows
    return mi.withColumn("rank", F.row_number().over(w).cast("long"))


# -------------------------------------------------------- histogram and KDE
def histogram(long: DataFrame, bins: int = 10, feature: str = "column", value: str = "value") -> DataFrame:
    """O-44: equal-width bins between each column's min and max (max falls in the last bin)."""
    rng = long.groupBy(feature).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    j = long.where(F.col(value).isNotNull()).join(F.broadcast(rng), feature)
    width = (F.col("__hi") - F.col("__lo")) / F.lit(bins)
    b = F.when(F.col("__hi") == F.col("__lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(value) - F.col("__lo")) / width), F.lit(bins - 1))
    ).cast("long")
    return j.withColumn("bin", b).groupBy(feature, "bin").agg(
        F.count(F.lit(1)).cast("long").alias("count"),
        F.first("__lo").alias("__lo"),
        F.first("__hi").alias("__hi"),
    ).select(
        feature,
        "bin",
        (F.col("__lo") + F.col("bin") * (F.col("__hi") - F.col("__lo")) / bins).alias("bin_start"),
        "count",
    )


def kde_curve(long: DataFrame, grid: int = 50, feature: str = "column", value: str = "value") -> DataFrame:
    """O-44: Gaussian KDE (Scott bandwidth σ·n^(−1/5)) evaluated on ``grid`` points per column.

    One grouped aggregation with ``grid`` kernel sums (codegen'd expressions, no
    row expansion and no join of rows with the grid); the per-column range and
    bandwidth come from a first small aggregation, broadcast (one row per column).
    """
    v = long.select(feature, value).where(F.col(value).isNotNull())
    st = v.groupBy(feature).agg(
        F.count(F.lit(1)).alias("__n"), F.stddev_samp(value).alias("__s"),
        F.min(value).alias("__lo"), F.max(value).alias("__hi"),
    ).withColumn("__h", F.col("__s") * F.pow(F.col("__n").cast("double"), F.lit(-0.2)))
    j = v.join(F.broadcast(st), feature)
    norm = F.lit(1.0 / math.sqrt(2 * math.pi))

    def gpt(i: int) -> Column:
        return F.col("__lo") + (F.col("__hi") - F.col("__lo")) * F.lit(i) / F.lit(grid - 1)

    sums = [F.sum(F.exp(F.lit(-0.5) * F.pow((gpt(i) - F.col(value)) / F.col("__h"), 2)) * norm).alias(f"__k{i}")
            for i in range(grid)]
    agg = j.groupBy(feature, "__n", "__h", "__lo", "__hi").agg(*sums)
    long_out = agg.select(
        feature, "__n", "__h", "__lo", "__hi",
        F.explode(F.array(*[F.struct(F.lit(i).alias("gi"), F.col(f"__k{i}").alias("k")) for i in range(grid)])).alias("__p"),
    )
    return long_out.select(
        feature,
        F.col("__p.gi").alias("gi"),
        (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * F.col("__p.gi") / F.lit(grid - 1)).alias("x"),
        (F.col("__p.k") / (F.col("__n") * F.col("__h"))).alias("density"),
    )


# ------------------------------------------------------------- group argmax
def group_mean_argmax(df: DataFrame, group: str, metric: str, lower_is_better: bool = False) -> DataFrame:
    """O-46: mean metric per group and the best group (max mean; min for error metrics)."""
    means = df.groupBy(group).agg(F.avg(metric).alias("mean_metric"))
    pick = F.min_by if lower_is_better else F.max_by
    best = means.agg(pick(F.col(group), F.col("mean_metric")).alias("__best"))
    return _one(means).join(_one(best), "__one").select(
        group, "mean_metric", F.col(group).eqNullSafe(F.col("__best")).alias("is_best")
    )
