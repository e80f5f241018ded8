"""Column profiles in long layout (O-26..O-35, O-38, O-45).

Every per-column statistic runs on the long layout ``(row id, column, value)``
produced by one ``unpivot``: a single shuffle keyed by ``column`` serves all
columns, instead of one job per column, and wide tables never hit codegen's
field limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import QC_POSITIVE_TOKENS, TRUE_FALSE_TOKENS, normalize_text
from .rank import exact_quantiles


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], var: str = "column", value: str = "value",
         dtype: str = "double") -> DataFrame:
    """Long layout: one row per (ids, column) with the value cast to ``dtype``."""
    return df.select(*ids, *[F.col(f"`{c}`").cast(dtype).alias(c) for c in cols]).unpivot(
        list(ids), list(cols), var, value
    )


def duplicate_count(df: DataFrame, id_col: str) -> DataFrame:
    """O-26: rows whose id was already seen = rows − distinct ids (NULL ids count as one value)."""
    return df.agg(
        (
            F.count(F.lit(1))
            - F.countDistinct(id_col)
            - F.max(F.when(F.col(id_col).isNull(), 1).otherwise(0))
        ).cast("long").alias("duplicates")
    ).withColumn("has_duplicates", F.col("duplicates") > 0)


def dedupe_first(df: DataFrame, id_col: str, seq_col: str) -> DataFrame:
    """O-27: first row per id in ``seq`` order; ``seq`` is unique within an id.

    The least ``seq`` per id is a hash aggregation (one row per id and task before the shuffle), and a semi-join on
    (id, seq) then picks the rows, whatever types the other columns have. The join is never a broadcast: the least
    rows are as many as ids and would pass through the driver.
    """
    least = df.groupBy(F.col(id_col).alias("__id")).agg(F.min(seq_col).alias("__seq"))
    least = least.hint("merge")
    return df.join(least, df[id_col].eqNullSafe(least["__id"]) & df[seq_col].eqNullSafe(least["__seq"]), "left_semi")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """O-28: NULL (and NaN) count per column from one aggregation, in long form."""
    cols = list(cols or df.columns)
    dtypes = dict(df.dtypes)

    def is_missing(c: str) -> Column:
        m = F.col(f"`{c}`").isNull()
        if dtypes[c] in ("double", "float"):
            m = m | F.isnan(F.col(f"`{c}`"))
        return m

    wide = df.agg(*[F.sum(is_missing(c).cast("long")).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column", "null_count")
    return long.withColumn("null_count", F.coalesce(F.col("null_count"), F.lit(0)).cast("long")).withColumn(
        "has_nulls", F.col("null_count") > 0
    )


def iqr_profile(df: DataFrame, id_col: str, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """O-29: per column Q1, Q3, IQR, fences, outlier count and flag (exact quantiles)."""
    long = melt(df.withColumn("__rid", F.col(f"`{id_col}`")), ["__rid"], cols)
    q = exact_quantiles(long, ["column"], "value", [0.25, 0.75], names=["q1", "q3"])
    q = (
        q.withColumn("iqr", F.col("q3") - F.col("q1"))
        .withColumn("lower", F.col("q1") - k * F.col("iqr"))
        .withColumn("upper", F.col("q3") + k * F.col("iqr"))
    )
    # One params row per column: broadcast is bounded by the column count.
    flagged = long.join(F.broadcast(q.select("column", "lower", "upper")), "column")
    counts = flagged.groupBy("column").agg(
        F.sum(((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))).cast("long")).alias("outliers")
    )
    return q.join(counts, "column", "left").withColumn(
        "outliers", F.coalesce(F.col("outliers"), F.lit(0)).cast("long")
    ).withColumn("has_outliers", F.col("outliers") > 0)


def cardinality_profile(df: DataFrame, cols: Sequence[str], high: int = 20, approx: bool = False) -> DataFrame:
    """O-30: distinct count of trimmed, lower-cased non-null values per text column."""
    long = melt(df, [], cols, dtype="string").withColumn("value", normalize_text("value"))
    agg = F.approx_count_distinct("value") if approx else F.countDistinct("value")
    return long.groupBy("column").agg(agg.cast("long").alias("cardinality")).withColumn(
        "high_cardinality", F.col("cardinality") > high
    )


def boolean_candidates(df: DataFrame, cols: Sequence[str], tokens: Sequence[str] = QC_POSITIVE_TOKENS) -> DataFrame:
    """O-31: text columns with exactly two distinct normalised values, one of them a positive token.

    Least and greatest value and "is any value neither of them" decide exactly two; all are mergeable, so a column of
    many distinct values costs no more than one of two. ``cardinality`` is 0, 1, 2 or 3 (more than two).
    """
    long = melt(df, [], cols, dtype="string").withColumn("value", normalize_text("value"))
    ends = long.groupBy("column").agg(F.min("value").alias("__lo"), F.max("value").alias("__hi"))
    between = (F.col("value") != F.col("__lo")) & (F.col("value") != F.col("__hi"))
    per = long.join(F.broadcast(ends), "column").groupBy("column").agg(  # one row a column is broadcast
        F.first("__lo").alias("__lo"), F.first("__hi").alias("__hi"), F.coalesce(F.max(between), F.lit(False)).alias("__more")
    )
    card = (
        F.when(F.col("__lo").isNull(), 0).when(F.col("__lo") == F.col("__hi"), 1).when(F.col("__more"), 3).otherwise(2)
    ).cast("long")
    positive = F.coalesce(F.col("__lo").isin(list(tokens)) | F.col("__hi").isin(list(tokens)), F.lit(False))
    return per.select("column", card.alias("cardinality"), ((card == 2) & positive).alias("is_boolean_candidate"))


def true_false_candidates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """O-32: text columns whose non-null normalised values are all in {true, false}, at least one."""
    long = melt(df, [], cols, dtype="string").withColumn("value", normalize_text("value"))
    per = long.groupBy("column").agg(
        F.count("value").cast("long").alias("non_null"),
        F.coalesce(F.bool_and(F.when(F.col("value").isNotNull(), F.col("value").isin(*TRUE_FALSE_TOKENS))), F.lit(True)).alias("__all"),
    )
    return per.select("column", ((F.col("non_null") > 0) & F.col("__all")).alias("is_true_false"))


def value_counts(df: DataFrame, c: str, normalize: bool = True, dropna: bool = False) -> DataFrame:
    """O-34: frequency of each (normalised) value; NULL is its own group unless ``dropna``."""
    v = normalize_text(c) if normalize else F.col(c)
    out = df.select(v.alias("value")).groupBy("value").agg(F.count(F.lit(1)).cast("long").alias("count"))
    return out.where(F.col("value").isNotNull()) if dropna else out


def frequency_threshold(freq: DataFrame, count_col: str = "count", multiplier: float = 2.0) -> DataFrame:
    """O-35: median(freq) − multiplier·var_samp(freq); a NULL variance counts as 0.

    ``freq`` is the (small) value-count table, one row per distinct value.
    """
    med = exact_quantiles(freq, [], count_col, [0.5], names=["median_freq"])
    var = freq.agg(F.coalesce(F.var_samp(count_col), F.lit(0.0)).alias("var_freq"))
    one = F.lit(1).alias("__one")
    return med.select("*", one).join(var.select("*", one), "__one").drop("__one").withColumn(
        "threshold", F.col("median_freq") - F.lit(multiplier) * F.col("var_freq")
    )


def kurtosis_g2(n: Column, pop_kurt: Column) -> Column:
    """Bias-corrected excess kurtosis from Spark's population excess kurtosis."""
    nd = n.cast("double")
    return F.when(
        nd > 3, (nd - 1) / ((nd - 2) * (nd - 3)) * ((nd + 1) * pop_kurt + 6)
    )


def moments_profile(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """O-38: count, mean, std (ddof 1), min, max, zero ratio, bias-corrected kurtosis per column."""
    long = melt(df, list(ids), cols).where(F.col("value").isNotNull() & ~F.isnan("value"))
    g = long.groupBy("column").agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg((F.col("value") == 0).cast("double")).alias("zero_ratio"),
        F.kurtosis("value").alias("__k"),
    )
    return g.withColumn("kurtosis", kurtosis_g2(F.col("n"), F.col("__k"))).drop("__k")


def boxplot_stats(df: DataFrame, id_col: str, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """O-45: Q1, median, Q3, whiskers (extreme values inside the fences) and flier count."""
    long = melt(df.withColumn("__rid", F.col(f"`{id_col}`")), ["__rid"], cols).where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )
    q = exact_quantiles(long, ["column"], "value", [0.25, 0.5, 0.75], names=["q1", "median", "q3"])
    q = q.withColumn("lower", F.col("q1") - k * (F.col("q3") - F.col("q1"))).withColumn(
        "upper", F.col("q3") + k * (F.col("q3") - F.col("q1"))
    )
    j = long.join(F.broadcast(q.select("column", "lower", "upper")), "column")
    inside = (F.col("value") >= F.col("lower")) & (F.col("value") <= F.col("upper"))
    w = j.groupBy("column").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.sum((~inside).cast("long")).alias("fliers"),
    )
    return q.drop("lower", "upper").join(w, "column")
