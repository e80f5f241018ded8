"""Projections, filters, joins and set operations (O-08..O-20, O-24, O-57, O-59, O-60).

Projections are resolved against ``df.columns`` / ``df.schema`` when the plan is
built, so Catalyst prunes the parquet scan to exactly the kept columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


# ---------------------------------------------------------------- projections
def project_complement(df: DataFrame, exclude: Iterable[str]) -> DataFrame:
    """O-08: all columns not in ``exclude`` (e.g. the signal columns), in table order."""
    ex = set(exclude)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in ex])


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric, non-boolean columns (O-09)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def categorical_columns(df: DataFrame) -> list[str]:
    """Text or boolean columns (O-09)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]


def project_by_type(df: DataFrame, kind: str = "numeric") -> DataFrame:
    """O-09: keep numeric (non-boolean) or categorical (text/boolean) columns."""
    cols = numeric_columns(df) if kind == "numeric" else categorical_columns(df)
    return df.select(*[F.col(f"`{c}`") for c in cols])


def resolve_by_prefix(columns: Sequence[str], wanted: Sequence[str]) -> list[str]:
    """O-10 resolution: a wanted name stands for itself if it is a column, else for all columns ``name_...``.

    Every column is looked up once under itself and under each of its prefixes that end before an underscore.
    """
    under: dict[str, list[str]] = {}
    for c in columns:
        for i, ch in enumerate(c):
            if ch == "_":
                under.setdefault(c[:i], []).append(c)
    exact = set(columns)
    hits = ([w] if w in exact else under.get(w, []) for w in wanted)
    return list({c: None for group in hits for c in group})


def project_by_prefix(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in resolve_by_prefix(df.columns, wanted)])


def project_by_regex(df: DataFrame, pattern: str, keep: Sequence[str] = ()) -> DataFrame:
    """O-11: columns whose name matches ``pattern`` from the start (pandas ``str.match``)."""
    rx = re.compile(pattern)
    cols = list(keep) + [c for c in df.columns if rx.match(c) and c not in keep]
    return df.select(*[F.col(f"`{c}`") for c in cols])


def drop_if_exists(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """O-12: drop columns, silently ignoring absent ones."""
    return df.drop(*[c for c in cols if c in df.columns])


def align_features(df: DataFrame, features: Sequence[str], strict: bool = False, fill: float = 0.0) -> DataFrame:
    """O-17: trained feature order; missing ones skipped (default) or filled with ``fill`` (strict)."""
    present = set(df.columns)
    if strict:
        return df.select(*[F.col(f"`{c}`") if c in present else F.lit(fill).alias(c) for c in features])
    return df.select(*[F.col(f"`{c}`") for c in features if c in present])


# -------------------------------------------------------------------- filters
def ne_pandas(c: str | Column, value) -> Column:
    """pandas ``!=``: NULL != x is true."""
    x = F.col(f"`{c}`") if isinstance(c, str) else c
    return ~x.eqNullSafe(F.lit(value))


def filter_ne_or_eq(df: DataFrame, a: str, x, b: str, y) -> DataFrame:
    """O-13: ``(a != x) OR (b == y)`` with pandas NULL semantics."""
    return df.where(ne_pandas(a, x) | F.coalesce(F.col(b) == F.lit(y), F.lit(False)))


def filter_eq(df: DataFrame, c: str, value) -> DataFrame:
    """O-14: keep rows equal to ``value`` (NULL never equal)."""
    return df.where(F.col(c) == F.lit(value))


def filter_column_fallback(df: DataFrame, a: str, x, b: str, y) -> DataFrame:
    """O-15: O-13 when column ``a`` exists, else only ``b == y``; decided at plan build."""
    if a in df.columns:
        return filter_ne_or_eq(df, a, x, b, y)
    return filter_eq(df, b, y)


def filter_null_safe_metadata(df: DataFrame, flag: str, flag_value: str, required: Sequence[str]) -> DataFrame:
    """O-16: ``flag != flag_value`` (NULL kept) and every ``required`` column not NULL."""
    cond = ne_pandas(flag, flag_value)
    for c in required:
        cond = cond & F.col(f"`{c}`").isNotNull()
    return df.where(cond)


def set_membership(df: DataFrame, c: str, values: Sequence | DataFrame, value_col: str | None = None) -> DataFrame:
    """O-18: rows whose ``c`` is in a set.

    A short literal list stays an ``IN`` predicate (pushed to the scan); a set
    given as a DataFrame is a left-semi join, planned by size (broadcast when AQE
    measures it small, else shuffled) so the set may be arbitrarily large.
    """
    if isinstance(values, DataFrame):
        vc = value_col or values.columns[0]
        s = values.select(F.col(vc).alias("__v")).distinct()
        return df.join(s, F.col(c) == F.col("__v"), "left_semi")
    return df.where(F.col(c).isin(list(values)))


def drop_any_null(df: DataFrame) -> DataFrame:
    """Rows with no NULL in any column (works with dotted column names)."""
    cond = F.lit(True)
    for c in df.columns:
        cond = cond & F.col(f"`{c}`").isNotNull()
    return df.where(cond)


def clean_rows(df: DataFrame, drop: Sequence[str] = ()) -> DataFrame:
    """O-19: drop columns, distinct rows, then drop rows with any NULL."""
    return drop_any_null(drop_if_exists(df, drop).distinct())


# ---------------------------------------------------------------------- joins
def align_by_id(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """O-20: attach columns by id (the Spark form of index alignment).

    Join strategy is left to the planner: a small side is broadcast from its
    measured size (AQE), otherwise both sides shuffle on the id.
    """
    return left.join(right, on=on, how=how)


def unseen_labels(
    df: DataFrame, label: str, cohort: str, cohorts: Sequence[str], fold_col: str = "fold"
) -> DataFrame:
    """O-24: per LOCO fold, labels present in the held-out cohort but absent from its train rows.

    Works on distinct (cohort, label) pairs only, so the anti join is small even
    for a very large table.
    """
    from .split import loco_train

    pairs = df.select(F.col(cohort).cast("string").alias("__c"), F.col(label).cast("string").alias(label)).distinct()
    test = pairs.where(F.col("__c").isNotNull()).select(F.col("__c").alias(fold_col), label)
    test = test.where(F.col(fold_col).isin(list(cohorts)))
    train = loco_train(pairs, "__c", cohorts, fold_col).select(fold_col, label).distinct()
    cond = (test[fold_col] == train[fold_col]) & test[label].eqNullSafe(train[label])
    return test.join(train, cond, "left_anti")


# ------------------------------------------------------------ sort, top, sets
def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """O-57: sort and keep k rows (planned as a distributed TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(k)


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """O-59: distinct rows of ``a`` not in ``b`` (NULL-safe, like ``EXCEPT``)."""
    return a.subtract(b)


def set_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Ordered union-distinct by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.distinct()


def is_subset(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: is every distinct row of ``a`` in ``b``."""
    missing = a.select(*a.columns).subtract(b.select(*a.columns))
    return missing.agg((F.count(F.lit(1)) == 0).alias("is_subset"))


def union_folds(frames: Sequence[DataFrame], fold_col: str = "fold", folds: Sequence[str] | None = None) -> DataFrame:
    """O-60: all per-fold results as one frame with a fold column."""
    out = None
    for i, f in enumerate(frames):
        g = f if fold_col in f.columns else f.withColumn(fold_col, F.lit(str(folds[i] if folds else i)))
        out = g if out is None else out.unionByName(g, allowMissingColumns=True)
    return out
