"""Leakage-free preprocessing (O-89): fit on the training rows, apply anywhere.

Order (as the reference's code runs it): dedupe → boolean casts → coerce
signal columns → IQR clip → threshold signals → rare grouping → split X/y and
drop id/cohort → impute → one-hot → centre train signals per cohort → scale →
encode target.

Fitting runs a handful of aggregations over the training rows (long layout,
exact quantiles via skew-safe ranks); every fitted parameter is per column (or
per cohort × column), so it is collected as literals and applying it is one
narrow ``select`` chain that Catalyst fuses into a single codegen stage.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import threshold_small
from ..functions.text import CAST_POSITIVE_TOKENS, RARE, UNKNOWN, token_boolean, true_false_cast
from ..operators.encode import MAX_CATEGORIES, coerce_numeric, fit_coercion, fit_rare
from ..operators.profile import dedupe_first, melt, true_false_candidates
from ..operators.rank import exact_quantiles
from ..operators.relational import categorical_columns, numeric_columns
from ..operators.scale import NO_SCALING, SIGNAL, choose_scaler, iqr_clip_expr, transform_expr
from ..session import stored


@dataclass
class PrepSpec:
    id_col: str
    cohort_col: str
    targets: list[str]
    signal_cols: list[str] = field(default_factory=list)
    has_duplicates: bool = False
    seq_col: str | None = None
    boolean_cast_columns: list[str] = field(default_factory=list)
    outlier_columns: list[str] = field(default_factory=list)
    high_cardinality_columns: list[str] = field(default_factory=list)
    task: str = "regression"
    rare_multiplier: float = 2.0
    signal_threshold: float = 1.5


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def clean_rows(df: DataFrame, spec: PrepSpec, tf_cols: Sequence[str], strict: dict[str, bool] | None = None) -> DataFrame:
    """Boolean casts, true/false casts and signal coercion, in one projection before and one within the coercion."""
    casts = {c: token_boolean(_q(c), CAST_POSITIVE_TOKENS) for c in spec.boolean_cast_columns}
    casts |= {c: true_false_cast(casts.get(c, _q(c))) for c in tf_cols}
    out = df.select(*[casts[c].alias(c) if c in casts else _q(c) for c in df.columns]) if casts else df
    return coerce_numeric(out, [c for c in spec.signal_cols if c in out.columns], strict)


def dedupe(df: DataFrame, spec: PrepSpec) -> DataFrame:
    """First row per id for fitting and evaluation; scoring keeps every row of its batch."""
    if not spec.has_duplicates:
        return df
    if not spec.seq_col:
        raise ValueError("has_duplicates needs seq_col, the column that orders an id's rows")
    return dedupe_first(df, spec.id_col, spec.seq_col)


def fit_preprocess(train: DataFrame, spec: PrepSpec) -> dict:
    """Fit every step on the training rows; returns a small dict of literals (and one rare table per column)."""
    text_cols = [c for c in categorical_columns(train) if c not in (spec.id_col, spec.cohort_col, *spec.targets)]
    tf = [r["column"] for r in true_false_candidates(train, text_cols).where("is_true_false").collect()] if text_cols else []
    if spec.has_duplicates:  # the first rows per id are found once, not in every job of the fit
        train = stored(dedupe(train, spec), "first-rows")
    strict = fit_coercion(train, [c for c in spec.signal_cols if c in train.columns])
    t = clean_rows(train, spec, tf, strict)
    p: dict = {"true_false_columns": tf, "strict_numbers": strict}

    # IQR clip bounds (train quantiles), one long-layout job for all outlier columns
    num_now = set(numeric_columns(t))
    clip_cols = [c for c in spec.outlier_columns if c in num_now]
    p["clip"] = {}
    if clip_cols:
        long = melt(t.withColumn("__rid", _q(spec.id_col)), ["__rid"], clip_cols)
        q = exact_quantiles(long, ["column"], "value", [0.25, 0.75], names=["q1", "q3"]).collect()
        for r in q:
            if r["q1"] is not None:
                iqr = r["q3"] - r["q1"]
                p["clip"][r["column"]] = (r["q1"], r["q3"], r["q1"] - 1.5 * iqr, r["q3"] + 1.5 * iqr)
    t = apply_clip_threshold(t, p, spec)

    # rare grouping: the rare values per column (bounded by the column's distinct count)
    p["rare"] = {}
    for c in spec.high_cardinality_columns:
        if c in t.columns:
            vals = [r[0] for r in fit_rare(t, c, spec.rare_multiplier).limit(MAX_CATEGORIES + 1).collect()]
            if len(vals) > MAX_CATEGORIES:
                raise ValueError(f"{c}: more than {MAX_CATEGORIES} rare values")
            p["rare"][c] = vals
    t = apply_rare(t, p)

    x = t.drop(*spec.targets, spec.id_col, spec.cohort_col)  # X without targets, id and cohort
    cat = categorical_columns(x)
    num = numeric_columns(x)
    p["categorical"], p["numeric"] = cat, num
    # numeric medians (exact), one job
    p["medians"] = {}
    if num:
        long = melt(t.withColumn("__rid", _q(spec.id_col)), ["__rid"], num)
        for r in exact_quantiles(long, ["column"], "value", [0.5], names=["median"]).collect():
            p["medians"][r["column"]] = r["median"]
    x = impute_encode_input(t, p, spec)
    # one-hot vocabulary: sorted categories of the imputed text, all columns in one bounded job
    p["categories"] = {c: [] for c in cat}
    if cat:
        long_cat = melt(x, [], cat, dtype="string").distinct().limit(MAX_CATEGORIES * len(cat) + 1).collect()
        for r in long_cat:
            p["categories"][r["column"]].append(r["value"])
        for c in cat:
            if len(p["categories"][c]) > MAX_CATEGORIES:
                raise ValueError(f"{c}: too many categories for one-hot encoding")
            p["categories"][c] = sorted(p["categories"][c])
    x = one_hot_apply(x, p)
    # cohort offsets of the signal columns (train only): mean per cohort − global mean
    sig = [c for c in spec.signal_cols if c in x.columns]
    p["offsets"] = {}
    if sig:
        coh = F.coalesce(_q(spec.cohort_col).cast("string"), F.lit("nan"))
        xs = x.withColumn("__coh", coh)
        # per-cohort and global means in one job (rollup: the grand total has grouping id 1)
        rows = xs.rollup("__coh").agg(F.grouping_id().alias("__gid"), *[F.avg(_q(c)).alias(c) for c in sig]).collect()
        a = next(r for r in rows if r["__gid"] == 1)
        for r in rows:
            if r["__gid"] == 0:
                p["offsets"][r["__coh"]] = {c: (r[c] - a[c]) if r[c] is not None and a[c] is not None else 0.0
                                            for c in sig}
        x = center_apply(xs, p, spec).drop("__coh")
    # scaler decision + parameters per numeric column after encoding
    feats = [c for c in numeric_columns(x) if c not in (spec.id_col, spec.cohort_col, *spec.targets)]
    p["features"] = feats
    long = melt(x.withColumn("__rid", _q(spec.id_col)), ["__rid"], feats)
    sc = choose_scaler(long, signal_cols=sig).collect()
    p["scalers"] = {r["column"]: r.asDict() for r in sc}
    # target classes (sorted text), for classification tasks
    p["classes"] = {}
    if spec.task != "regression":
        for c in spec.targets:
            p["classes"][c] = [r[0] for r in train.select(_q(c).cast("string").alias("v")).distinct().orderBy("v").collect()]
    return p


def apply_clip_threshold(df: DataFrame, p: dict, spec: PrepSpec) -> DataFrame:
    out = df
    for c, (q1, q3, lo, hi) in p["clip"].items():
        if c in out.columns:
            out = out.withColumn(c, iqr_clip_expr(_q(c), F.lit(q1), F.lit(q3), F.lit(lo), F.lit(hi)))
    for c in spec.signal_cols:
        if c in out.columns and isinstance(out.schema[c].dataType, (T.DoubleType, T.FloatType, T.IntegerType, T.LongType)):
            out = out.withColumn(c, threshold_small(_q(c), spec.signal_threshold))
    return out


def apply_rare(df: DataFrame, p: dict) -> DataFrame:
    out = df
    for c, vals in p["rare"].items():
        if c in out.columns:
            name = f"{c}_grouped"
            rare = _q(c).isin([v for v in vals if v is not None])
            rare = F.coalesce(rare, F.lit(None in vals))  # a rare NULL is grouped as well
            out = out.withColumn(name, F.when(rare, F.lit(RARE)).otherwise(_q(c).cast("string")))
    return out


def impute_encode_input(df: DataFrame, p: dict, spec: PrepSpec) -> DataFrame:
    out = df
    for c in p["categorical"]:
        if c in out.columns:
            dt = dict(out.dtypes)[c]
            txt = (F.when(_q(c), F.lit("True")).when(~_q(c), F.lit("False")) if dt == "boolean" else _q(c).cast("string"))
            out = out.withColumn(c, F.coalesce(txt, F.lit(UNKNOWN)))
    for c, m in p["medians"].items():
        if c in out.columns and m is not None:
            out = out.withColumn(c, F.coalesce(_q(c).cast("double"), F.lit(float(m))))
    return out


def one_hot_apply(df: DataFrame, p: dict) -> DataFrame:
    new = []
    for c, vals in p["categories"].items():
        for v in vals:
            new.append(F.coalesce(_q(c) == F.lit(v), F.lit(False)).cast("double").alias(f"{c}_{v}"))
    keep = [_q(c) for c in df.columns if c not in p["categories"]]
    return df.select(*keep, *new)


def center_apply(df: DataFrame, p: dict, spec: PrepSpec) -> DataFrame:
    """Train rows only: subtract the row's cohort offset (literal map per column)."""
    if not p["offsets"]:
        return df
    cols = next(iter(p["offsets"].values())).keys()
    coh = F.coalesce(_q(spec.cohort_col).cast("string"), F.lit("nan"))
    out = df
    for c in cols:
        m = F.create_map(*[x for k, o in p["offsets"].items() for x in (F.lit(k), F.lit(float(o[c])))])
        out = out.withColumn(c, _q(c) - F.coalesce(F.element_at(m, coh), F.lit(0.0)))
    return out


def scale_apply(df: DataFrame, p: dict) -> DataFrame:
    exprs = []
    for c in df.columns:
        s = p["scalers"].get(c)
        if s is None or s["decision"] in (NO_SCALING, SIGNAL):
            exprs.append(_q(c))
            continue
        lit = {k: F.lit(s.get(k)).cast("double") for k in ["min", "max", "mean", "std", "median", "iqr"]}
        exprs.append(transform_expr(_q(c).cast("double"), F.lit(s["decision"]), lit).alias(c))
    return df.select(*exprs)


def encode_targets(df: DataFrame, p: dict, spec: PrepSpec) -> DataFrame:
    out = df
    for c, classes in p["classes"].items():
        if c not in out.columns:
            continue
        m = F.create_map(*[x for i, v in enumerate(classes) for x in (F.lit(v), F.lit(float(i)))])
        code = F.element_at(m, _q(c).cast("string"))
        out = out.withColumn(
            c, F.when(code.isNull(), F.raise_error(F.concat(F.lit(f"unseen label in {c}: "), _q(c).cast("string"))))
            .otherwise(code)
        )
    return out


def apply_preprocess(df: DataFrame, p: dict, spec: PrepSpec, is_train: bool) -> DataFrame:
    """Apply the fitted steps; returns id, cohort, the scaled features and encoded targets."""
    t = clean_rows(dedupe(df, spec) if is_train else df, spec, p["true_false_columns"], p["strict_numbers"])
    t = apply_clip_threshold(t, p, spec)
    t = apply_rare(t, p)
    t = impute_encode_input(t, p, spec)
    t = one_hot_apply(t, p)
    if is_train:
        t = center_apply(t, p, spec)
    for c in p["features"]:
        if c not in t.columns:  # category unseen at apply time: all-zero column
            t = t.withColumn(c, F.lit(0.0))
    targets = [c for c in spec.targets if c in t.columns]  # scoring input has no targets
    t = t.select(spec.id_col, spec.cohort_col, *[_q(c) for c in p["features"]], *[_q(c) for c in targets])
    t = scale_apply(t, p)
    return encode_targets(t, p, spec)
