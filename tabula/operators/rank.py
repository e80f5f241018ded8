"""Skew-safe ranking primitives.

Spark's ``row_number().over(Window.partitionBy(k).orderBy(v))`` sends a whole
group to one task, and an empty ``partitionBy()`` sends the whole table to one
task. Every rank in this engine (rank-first, quantile bins, stratified folds,
exact quantiles, KS) instead goes through :func:`row_number_by`:

1. ``repartitionByRange`` on (group keys, order keys): a hot group is cut into
   many range partitions because the order keys end in a unique tiebreak;
2. ``sortWithinPartitions``; ``monotonically_increasing_id`` then carries the
   in-partition position in its low 33 bits;
3. a small table of (partition, group) counts, at most ``P + G - 1`` rows for
   ``P`` partitions and ``G`` groups, gives each group's offset per partition by
   a prefix sum; it is broadcast back (``G`` bounded, see ``groups_bounded``).

The range-sorted rows are written once with a reliable ``checkpoint`` into
``spark.checkpoint.dir`` before both uses: Spark seeds the range sampler with
the RDD id, so two separately planned uses of the same range repartition may
draw different bounds. Reading one written copy keeps partition ids and
positions identical for the counts and the rows, and survives executor loss.

The result is the exact ``row_number`` with one range shuffle and no task that
holds more than one range partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, shuffle_partitions, stored


def _cols(xs: Sequence[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def row_number_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    out: str = "rn",
    groups_bounded: bool = True,
    num_partitions: int | None = None,
) -> DataFrame:
    """Exact ``row_number() over (partition by keys order by order)``, skew-safe.

    ``order`` must end in a unique column for a deterministic result (needed so a
    recomputed partition after executor loss gets the same numbers).
    ``groups_bounded=False`` falls back to the plain window, which is right when
    groups are many and small (then no group is large).
    """
    keys = list(keys)
    if not groups_bounded:
        w = Window.partitionBy(*keys).orderBy(*_cols(order))
        return df.withColumn(out, F.row_number().over(w).cast("long"))

    n = num_partitions or shuffle_partitions(df.sparkSession)
    x = (
        df.repartitionByRange(n, *_cols(keys), *_cols(order))
        .sortWithinPartitions(*_cols(keys), *_cols(order))
        .withColumn("__rk_pid", F.spark_partition_id())
        .withColumn("__rk_mid", F.monotonically_increasing_id())
    )
    x = cut_lineage(x)
    stats = x.groupBy("__rk_pid", *keys).agg(
        F.count(F.lit(1)).alias("__rk_cnt"), F.min("__rk_mid").alias("__rk_first")
    )
    before = Window.partitionBy(*keys).orderBy("__rk_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("__rk_before", F.coalesce(F.sum("__rk_cnt").over(before), F.lit(0)))
    # Renamed copies of the keys so that NULL keys match null-safely.
    s = stats.select(
        F.col("__rk_pid").alias("__rk_spid"),
        *[F.col(k).alias(f"__rk_k{i}") for i, k in enumerate(keys)],
        "__rk_first",
        "__rk_before",
    )
    cond = x["__rk_pid"] == s["__rk_spid"]
    for i, k in enumerate(keys):
        cond = cond & x[k].eqNullSafe(s[f"__rk_k{i}"])
    joined = x.join(F.broadcast(s), cond, "inner")
    return joined.withColumn(
        out, (F.col("__rk_mid") - F.col("__rk_first") + F.col("__rk_before") + F.lit(1)).cast("long")
    ).drop("__rk_pid", "__rk_mid", "__rk_spid", "__rk_first", "__rk_before", *[f"__rk_k{i}" for i in range(len(keys))])


def group_counts(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """Row count per group (partial aggregation, so a hot group is pre-counted per task)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias(out))


# Arithmetic buckets per refinement step; a bucket with at most SMALL distinct values is ordered by a window.
# Both are independent of the cluster; the tests run other values.
BUCKETS = 4_096
SMALL = 100_000


def _group_key(keys: Sequence[str]) -> Column:
    """One text key per group (NULL-safe)."""
    if not keys:
        return F.lit("")
    return F.concat_ws("\u0001", *[F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in keys])


def value_table(df: DataFrame, keys: Sequence[str], value: str, carry: Sequence[str] = ()) -> DataFrame:
    """(__gk, carry, __v, __n): how often each group has each value, NULL and NaN left out; written once.

    All exact order statistics start from it: counting is a partial aggregation, so a repeated value costs one row
    a task, and columns of few distinct values become tiny.
    """
    v = F.col(value).cast("double")
    rows = df.select(_group_key(keys).alias("__gk"), *carry, v.alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    return stored(rows.groupBy("__gk", *carry, "__v").agg(F.count(F.lit(1)).alias("__n")), "values")


def _bucket(buckets: int) -> Column:
    """Place of __v between __lo and __hi: 0 .. buckets - 1 by arithmetic, ascending with the value."""
    # halves keep the range of extreme doubles finite
    span = F.col("__hi") / 2 - F.col("__lo") / 2
    part = F.when(span > 0, (F.col("__v") / 2 - F.col("__lo") / 2) / span).otherwise(F.lit(0.0))
    return F.least(F.floor(F.coalesce(F.nanvl(part, F.lit(1.0)), F.lit(0.0)) * F.lit(float(buckets))), F.lit(buckets - 1)).cast("long")


def _bucket_counts(vt: DataFrame, segments: DataFrame, buckets: int, folds: Sequence[str] | None) -> DataFrame:
    """(__gk, __lo, __hi, __b, n, lo, hi, d, before): the buckets of each segment and the rows before them in it."""
    carry = ["__c"] if folds else []
    seg = segments.select("__gk", "__lo", "__hi").distinct()
    if folds:  # segments of all folds cut the one table; each fold then leaves its own cohort out
        rows = vt.join(seg.withColumnRenamed("__gk", "__f").withColumn("__gk", F.lit("")), "__gk").where(
            ~F.col("__c").eqNullSafe(F.col("__f"))
        ).drop("__gk", "__c").withColumnRenamed("__f", "__gk")
    else:
        rows = vt.join(seg, "__gk")
    rows = rows.where((F.col("__v") >= F.col("__lo")) & (F.col("__v") <= F.col("__hi")))
    counts = rows.groupBy("__gk", "__lo", "__hi", _bucket(buckets).alias("__b")).agg(
        F.sum("__n").alias("n"), F.min("__v").alias("lo"), F.max("__v").alias("hi"), F.count(F.lit(1)).alias("d")
    )
    run = Window.partitionBy("__gk", "__lo", "__hi").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(run), F.lit(0)))


def _inside(vt: DataFrame, segments: DataFrame, folds: Sequence[str] | None) -> DataFrame:
    """Rows (__gk, __lo, __hi, segment columns, __v, __n, __upto) of small segments, counted up in value order."""
    extra = [c for c in segments.columns if c not in ("__gk", "__lo", "__hi")]
    if folds:
        rows = vt.join(segments.withColumnRenamed("__gk", "__f").withColumn("__gk", F.lit("")), "__gk").where(
            ~F.col("__c").eqNullSafe(F.col("__f"))
        )
        rows = rows.where((F.col("__v") >= F.col("__lo")) & (F.col("__v") <= F.col("__hi")))
        rows = rows.groupBy(F.col("__f").alias("__gk"), "__lo", "__hi", *extra, "__v").agg(F.sum("__n").alias("__n"))
    else:
        rows = vt.join(segments, "__gk").where((F.col("__v") >= F.col("__lo")) & (F.col("__v") <= F.col("__hi")))
    run = Window.partitionBy("__gk", "__lo", "__hi").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("__upto", F.sum("__n").over(run))


def select_ranks(vt: DataFrame, want: DataFrame, buckets: int | None = None, folds: Sequence[str] | None = None) -> DataFrame:
    """(__gk, __r, __v): the value at each wanted 0-based rank of a group.

    ``want`` has __gk, __r and the group's __lo and __hi. Each step cuts the segment that holds a rank into
    arithmetic buckets and goes on in the bucket that holds it, until it has one value or at most SMALL distinct ones.
    """
    buckets = buckets or BUCKETS
    state, done = want.withColumn("__at", F.col("__r")), None
    while True:
        b = _bucket_counts(vt, state, buckets, folds)
        keys = ["__gk", "__lo", "__hi"]
        state = state.join(b, keys).where((F.col("__at") >= F.col("before")) & (F.col("__at") < F.col("before") + F.col("n")))
        state = stored(
            state.select(
                "__gk", "__r", F.col("lo").alias("__lo"), F.col("hi").alias("__hi"),
                (F.col("__at") - F.col("before")).alias("__at"), "d",
            ),
            "ranks",
        )
        ready = state.where((F.col("__lo") == F.col("__hi")) | (F.col("d") <= SMALL))
        done = ready if done is None else done.unionByName(ready)
        state = state.where((F.col("__lo") < F.col("__hi")) & (F.col("d") > SMALL)).drop("d")
        if state.isEmpty():
            break
    exact = done.where("__lo = __hi").select("__gk", "__r", F.col("__lo").alias("__v"))
    part = done.where("__lo < __hi").drop("d")
    rows = _inside(vt, part.select("__gk", "__lo", "__hi").distinct(), folds).drop("__c")
    hit = rows.join(part, ["__gk", "__lo", "__hi"]).where(
        (F.col("__at") < F.col("__upto")) & (F.col("__at") >= F.col("__upto") - F.col("__n"))
    )
    return exact.unionByName(hit.select("__gk", "__r", "__v"))


def _interpolated(groups: DataFrame, vt: DataFrame, probs: Sequence[float], names: Sequence[str], buckets: int | None,
                  folds: Sequence[str] | None = None) -> DataFrame:
    """``groups`` (__gk, __total, __lo, __hi, ...) with one column per probability (linear interpolation)."""
    ps = F.array(*[F.lit(float(p)) for p in probs])
    h = (F.col("__total") - 1).cast("double") * F.col("__p")
    at = groups.where("__total > 0").select("__gk", "__total", "__lo", "__hi", F.posexplode(ps).alias("__i", "__p"))
    at = at.withColumn("__floor", F.floor(h)).withColumn("__ceil", F.ceil(h)).withColumn("__frac", h - F.floor(h))
    want = at.select("__gk", "__lo", "__hi", F.explode(F.array("__floor", "__ceil")).alias("__r")).distinct()
    got = select_ranks(vt, want, buckets, folds)
    lo = got.select("__gk", F.col("__r").alias("__floor"), F.col("__v").alias("__vlo"))
    hi = got.select("__gk", F.col("__r").alias("__ceil"), F.col("__v").alias("__vhi"))
    q = at.join(lo, ["__gk", "__floor"]).join(hi, ["__gk", "__ceil"])
    val = F.col("__vlo") + (F.col("__vhi") - F.col("__vlo")) * F.col("__frac")
    wide = q.groupBy("__gk").agg(*[F.max(F.when(F.col("__i") == i, val)).alias(n) for i, n in enumerate(names)])
    return groups.join(wide, "__gk", "left")


def ks_deviation(groups: DataFrame, vt: DataFrame, buckets: int | None = None) -> DataFrame:
    """(__gk, ks_stat): largest distance of each group's empirical distribution from N(__mean, __std).

    The first and last value of a bucket give deviations that are attained; within it none exceeds the distance of
    the last count from the first value's probability (and the reverse). Only buckets whose bound is above what is
    attained so far are opened: by a window if small, else cut again.
    """
    from ..functions.numeric import normal_cdf

    buckets = buckets or BUCKETS
    g = groups.where("__std > 0").select("__gk", F.col("__total").cast("double").alias("__t"), "__mean", "__std")
    cdf = lambda c: normal_cdf((F.col(c) - F.col("__mean")) / F.col("__std"))
    seg = groups.where("__std > 0").select("__gk", "__lo", "__hi", F.lit(0).cast("long").alias("__start"))
    found = None
    while True:
        b = _bucket_counts(vt, seg, buckets, None).join(seg, ["__gk", "__lo", "__hi"]).join(g, "__gk")
        first, last = F.col("__start") + F.col("before"), F.col("__start") + F.col("before") + F.col("n")
        flo, fhi = cdf("lo"), cdf("hi")
        b = b.select(
            "__gk", "lo", "hi", "d", first.alias("first"),
            F.greatest(last / F.col("__t") - fhi, flo - first / F.col("__t")).alias("attained"),
            F.greatest(last / F.col("__t") - flo, fhi - first / F.col("__t")).alias("bound"),
        )
        b = stored(b, "ks")
        best = b.groupBy("__gk").agg(F.max("attained").alias("best"))
        found = best if found is None else found.unionByName(best).groupBy("__gk").agg(F.max("best").alias("best"))
        opened = b.join(found, "__gk").where("bound > best and lo < hi").select(
            "__gk", F.col("lo").alias("__lo"), F.col("hi").alias("__hi"), F.col("first").alias("__start"), "d"
        )
        small = opened.where(F.col("d") <= SMALL).drop("d")
        rows = _inside(vt, small, None).join(g, "__gk")
        upto = F.col("__start") + F.col("__upto")
        dev = F.greatest(upto / F.col("__t") - cdf("__v"), cdf("__v") - (upto - F.col("__n")) / F.col("__t"))
        inner = rows.groupBy("__gk").agg(F.max(dev).alias("best"))
        found = stored(found.unionByName(inner).groupBy("__gk").agg(F.max("best").alias("best")), "ks")
        seg = opened.where(F.col("d") > SMALL).drop("d")
        if seg.isEmpty():
            return found.select("__gk", F.col("best").alias("ks_stat"))


def _groups(df: DataFrame, keys: Sequence[str], value: str, extra: Sequence[Column] = ()) -> DataFrame:
    """One row per group of ``df`` (groups without any value too): keys, __gk, __total, __lo, __hi and ``extra``."""
    v = F.col(value).cast("double")
    rows = df.select(*keys, _group_key(keys).alias("__gk"), F.when(v.isNotNull() & ~F.isnan(v), v).alias("__v"))
    agg = [F.count("__v").alias("__total"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), *extra]
    if not keys:
        return rows.agg(*agg).withColumn("__gk", F.lit(""))
    return rows.groupBy("__gk").agg(*agg, *[F.first(k).alias(k) for k in keys])


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Exact linear-interpolation quantiles per group (pandas / ``quantile_cont``); NULL and NaN are ignored."""
    keys = list(keys)
    names = list(names) if names else [f"q_{str(p).replace('.', '_')}" for p in probs]
    groups = stored(_groups(df, keys, value), "groups")
    return _interpolated(groups, value_table(df, keys, value), probs, names, buckets).select(*keys, *names)


def ks_normal_stats(df: DataFrame, keys: Sequence[str], value: str, buckets: int | None = None) -> DataFrame:
    """One-sample KS statistic against N(mean, std) per group: keys, n, mean, std, ks_stat."""
    keys = list(keys)
    extra = [F.avg("__v").alias("__mean"), F.stddev_samp("__v").alias("__std")]
    groups = stored(_groups(df, keys, value, extra), "groups")
    d = ks_deviation(groups, value_table(df, keys, value), buckets)
    return groups.join(d, "__gk", "left").select(
        *keys, F.col("__total").alias("n"), F.col("__mean").alias("mean"), F.col("__std").alias("std"), "ks_stat"
    )


def dense_codes(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str = "code") -> DataFrame:
    """0-based dense rank of distinct ``order`` values within ``keys`` (skew-safe).

    Input must already be one row per distinct value (e.g. after ``distinct``);
    then dense rank = row number - 1.
    """
    return row_number_by(df, keys, order, out=out).withColumn(out, F.col(out) - 1)


def distribution_profile(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                         names: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Moments, exact quantiles and the KS-normal statistic per group, all from one value table.

    Returns keys, n, mean, std, min, max, zero_ratio, kurt_pop (population excess kurtosis), ks_stat, <names>.
    """
    keys, x = list(keys), F.col("__v")
    extra = [F.avg(x).alias("__mean"), F.stddev_samp(x).alias("__std"),
             F.avg((x == 0).cast("double")).alias("zero_ratio"), F.kurtosis(x).alias("kurt_pop")]
    groups = stored(_groups(df, keys, value, extra), "groups")
    vt = value_table(df, keys, value)
    out = _interpolated(groups, vt, probs, list(names), buckets).join(ks_deviation(groups, vt, buckets), "__gk", "left")
    return out.select(
        *keys, F.col("__total").alias("n"), F.col("__mean").alias("mean"), F.col("__std").alias("std"),
        F.col("__lo").alias("min"), F.col("__hi").alias("max"), "zero_ratio", "kurt_pop", "ks_stat", *names,
    )
