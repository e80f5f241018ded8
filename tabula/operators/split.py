"""Cohort splits (leave-one-cohort-out), stratification, folds and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .rank import group_counts, row_number_by

# A LOCO fold list is brought to the driver; it must stay a small, bounded list.
MAX_COHORTS = 10_000


def cohort_list(df: DataFrame, cohort: str, max_cohorts: int = MAX_COHORTS) -> list[str]:
    """O-109: sorted distinct non-null cohorts as text; error if fewer than two.

    Only the distinct values (bounded by ``max_cohorts``) reach the driver.
    """
    vals = (
        df.select(F.col(cohort).cast("string").alias("c"))
        .where(F.col("c").isNotNull())
        .distinct()
        .orderBy("c")
        .limit(max_cohorts + 1)
        .collect()
    )
    cohorts = [r["c"] for r in vals]
    if len(cohorts) > max_cohorts:
        raise ValueError(f"more than {max_cohorts} cohorts in {cohort}; not a cohort column")
    if len(cohorts) < 2:
        raise ValueError(f"column {cohort} has {len(cohorts)} cohort(s): holding one out would leave no row to fit on")
    return cohorts


def cohort_frame(df: DataFrame, cohort: str) -> DataFrame:
    """O-109 as a DataFrame (no driver round trip): sorted distinct non-null cohorts as text."""
    return (
        df.select(F.col(cohort).cast("string").alias("cohort"))
        .where(F.col("cohort").isNotNull())
        .distinct()
    )


def loco_expand(
    df: DataFrame,
    cohort: str,
    cohorts: Sequence[str] | None = None,
    fold_col: str = "fold",
    role_col: str = "role",
) -> DataFrame:
    """O-21: one copy of each row per held-out cohort with a train/test role.

    The fold list is a literal array (bounded, from :func:`cohort_list`), so the
    expansion is a narrow ``explode`` with no join and no shuffle. A row is
    ``test`` in the fold of its own cohort and ``train`` in every other fold; a
    NULL cohort is ``train`` everywhere (pandas compares the text ``'nan'``).
    """
    cohorts = list(cohorts) if cohorts is not None else cohort_list(df, cohort)
    folds = F.array(*[F.lit(c) for c in cohorts])
    c_txt = F.col(cohort).cast("string")
    return df.withColumn(fold_col, F.explode(folds)).withColumn(
        role_col, F.when(c_txt.eqNullSafe(F.col(fold_col)), F.lit("test")).otherwise(F.lit("train"))
    )


def loco_train(df: DataFrame, cohort: str, cohorts: Sequence[str] | None = None, fold_col: str = "fold") -> DataFrame:
    """Train rows of every LOCO fold only (each row into the k-1 folds it trains)."""
    cohorts = list(cohorts) if cohorts is not None else cohort_list(df, cohort)
    c_txt = F.col(cohort).cast("string")
    others = F.filter(F.array(*[F.lit(c) for c in cohorts]), lambda f: ~c_txt.eqNullSafe(f))
    return df.withColumn(fold_col, F.explode(others))


def md5_order(id_col: str, seed: int = 42) -> Column:
    """Repeatable pseudo-random order key: md5 of ``id:seed`` (same text in any SQL engine)."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


# Rows per window task when numbering rows in hash order.
ROWS_PER_TASK = 2_000_000


def hash_row_number(df: DataFrame, keys: Sequence[str], id_col: str, seed: int = 42, out: str = "rn",
                    group_sizes: dict | None = None) -> DataFrame:
    """Exact ``row_number() over (partition by keys order by md5(id:seed), id)`` without a sort of the table.

    An md5 prefix is uniform, so hash buckets are cut arithmetically from its first
    8 hex digits: B = ceil(largest group / ROWS_PER_TASK) buckets keep every window
    task near ROWS_PER_TASK rows however large (or hot) a group is. Per-(group,
    bucket) counts (a small table, broadcast) give each bucket's offset; the rank
    is offset + position inside the bucket's window. Deterministic, no sampling.
    """
    keys = list(keys)
    h = md5_order(id_col, seed)
    if group_sizes is None:
        group_sizes = {0: df.count()}
    b = max(1, -(-max(group_sizes.values() or [1]) // ROWS_PER_TASK))
    x = df.withColumn("__h", h).withColumn(
        "__hb", (F.conv(F.substring("__h", 1, 8), 16, 10).cast("long") * F.lit(b) / F.lit(1 << 32)).cast("long")
    )
    counts = x.groupBy(*keys, "__hb").agg(F.count(F.lit(1)).alias("__c"))
    before = Window.partitionBy(*keys).orderBy("__hb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__c").over(before), F.lit(0))).drop("__c")
    o = offsets.select(*[F.col(k).alias(f"__ok{i}") for i, k in enumerate(keys)], F.col("__hb").alias("__ohb"), "__off")
    cond = x["__hb"] == o["__ohb"]
    for i, k in enumerate(keys):
        cond = cond & x[k].eqNullSafe(o[f"__ok{i}"])
    j = x.join(F.broadcast(o), cond)  # groups × buckets rows
    w = Window.partitionBy(*keys, "__hb").orderBy("__h", id_col)
    return j.withColumn(out, (F.col("__off") + F.row_number().over(w)).cast("long")).drop(
        "__h", "__hb", "__ohb", "__off", *[f"__ok{i}" for i in range(len(keys))]
    )


def rank_first(df: DataFrame, value: str, id_col: str, keys: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """O-48: rank with ties broken by row order (id), skew-safe, NULL values last."""
    return row_number_by(df, list(keys), [F.col(value).asc_nulls_last(), F.col(id_col)], out=out)


def qcut_rank_bins(
    df: DataFrame, value: str, id_col: str, keys: Sequence[str] = (), max_bins: int = 5, out: str = "bin"
) -> DataFrame:
    """O-49: q = min(max_bins, max(2, distinct)) equal-count bins of the rank-first order.

    pandas ``qcut`` of ranks 1..n with right-closed edges gives
    ``bin = max(0, ceil(r*q/n) - 1)``; written with integer division as
    ``((r-1)*q + n-2) div (n-1) - 1`` for the linear edges of ``qcut``.
    """
    keys = list(keys)
    stats = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).cast("long").alias("__n"), F.countDistinct(value).cast("long").alias("__d")
    )
    ranked = rank_first(df.where(F.col(value).isNotNull()), value, id_col, keys, out="__r")
    on = keys or ["__one"]
    if not keys:  # one global stats row, attached by a constant key
        ranked, stats = ranked.withColumn("__one", F.lit(1)), stats.withColumn("__one", F.lit(1))
    j = ranked.join(F.broadcast(stats), on, "inner").drop("__one")
    j = j.withColumn("__q", F.least(F.lit(max_bins), F.greatest(F.lit(2), F.col("__d"))).cast("long"))
    b = F.expr("CASE WHEN __n <= 1 THEN 0 ELSE greatest(((__r - 1) * __q + __n - 2) div (__n - 1) - 1, 0) END")
    return j.withColumn(out, b.cast("long")).drop("__n", "__d", "__r", "__q")


def stratified_folds(
    df: DataFrame, stratum: str, id_col: str, max_splits: int = 5, seed: int = 42, out: str = "fold"
) -> DataFrame:
    """O-53: stratified k-fold labels, k = min(max_splits, smallest stratum).

    Rows are numbered inside each stratum in md5(id:seed) order (skew-safe rank);
    fold = (number - 1) mod k, so per-stratum fold sizes differ by at most one.
    When the smallest stratum has fewer than two rows: plain k-fold over all rows
    with k = min(max_splits, n); with n < 2 an error.
    """
    sizes = {r[0]: r[1] for r in group_counts(df, [stratum], "__c").collect()}  # one row per stratum
    if not sizes:
        raise ValueError("cannot build folds from an empty frame")
    k = min(max_splits, int(min(sizes.values())))
    keys: list[str] = [stratum]
    if k < 2:
        total = int(sum(sizes.values()))
        k = min(max_splits, total)
        keys, sizes = [], {0: total}
        if k < 2:
            raise ValueError("inner CV needs at least two rows")
    ranked = hash_row_number(df, keys, id_col, seed, out="__r", group_sizes=sizes)
    return ranked.withColumn(out, ((F.col("__r") - 1) % k).cast("long")).drop("__r")


def train_val_test_split(
    df: DataFrame, id_col: str, holdout: float = 0.2, test_share: float = 0.5, seed: int = 42, out: str = "split"
) -> DataFrame:
    """O-54: exact-size 80/10/10 split by md5(id:seed) rank.

    Sizes follow two successive hold-outs: holdout m = ceil(0.2 n), test = ceil(0.5 m),
    validation = m - test, train = n - m.
    """
    import math

    n = df.count()
    m = math.ceil(holdout * n)
    n_test = math.ceil(test_share * m)
    a, b = n - m, n - n_test
    ranked = hash_row_number(df, [], id_col, seed, out="__r", group_sizes={0: n})
    return ranked.withColumn(
        out,
        F.when(F.col("__r") <= a, "train").when(F.col("__r") <= b, "validation").otherwise("test"),
    ).drop("__r")


def sample_n(df: DataFrame, id_col: str, n: int = 100, seed: int = 42) -> DataFrame:
    """O-110: repeatable sample of min(n, rows) rows: the n smallest md5(id:seed).

    ``orderBy().limit()`` plans as a distributed top-k (TakeOrderedAndProject):
    each task keeps n rows, the driver merges P*n rows.
    """
    return df.orderBy(md5_order(id_col, seed), F.col(id_col)).limit(n)


def loco_quantiles(df: DataFrame, cohort: str, value: str, probs: Sequence[float],
                   cohorts: Sequence[str] | None = None, names: Sequence[str] | None = None) -> DataFrame:
    """Exact train-split quantiles of every LOCO fold without copying rows per fold.

    One table of (cohort, value) counts serves all folds: a fold's counts are those of all cohorts but its own (a
    NULL cohort belongs to every fold's train split), and each fold opens only the buckets that hold its ranks.
    Returns (fold, one column per probability); a fold without train values has NULLs.
    """
    from .rank import _interpolated, value_table

    spark = df.sparkSession
    cohorts = list(cohorts) if cohorts is not None else cohort_list(df, cohort)
    names = list(names) if names else [f"q_{str(p).replace('.', '_')}" for p in probs]
    src = df.select(F.col(cohort).cast("string").alias("__c"), F.col(value).alias("__x"))
    vt = value_table(src, [], "__x", carry=["__c"])
    by = vt.groupBy("__c").agg(F.sum("__n").alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi"))
    folds = spark.createDataFrame([(c,) for c in cohorts], "fold string")
    pairs = by.withColumn("fold", F.explode(F.array(*[F.lit(c) for c in cohorts]))).where(~F.col("__c").eqNullSafe(F.col("fold")))
    groups = pairs.groupBy("fold").agg(F.sum("n").alias("__total"), F.min("lo").alias("__lo"), F.max("hi").alias("__hi"))
    groups = stored(groups.withColumnRenamed("fold", "__gk"), "folds")
    q = _interpolated(groups, vt, probs, names, None, cohorts).withColumnRenamed("__gk", "fold")
    return folds.join(q, "fold", "left").select("fold", *names)
