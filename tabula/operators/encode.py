"""Encoding, coercion, imputation and rare grouping (O-55, O-56, O-66, O-70..O-73).

Fit steps return small DataFrames or short literal lists (bounded by the number
of distinct categories, checked); apply steps are single ``select``s.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import parse_first_number, parse_strict
from ..functions.text import RARE, UNKNOWN
from .profile import frequency_threshold, value_counts
from .rank import exact_quantiles, row_number_by

# One-hot encoding into columns writes one per category; a column with more distinct
# values than this is refused there and goes into a sparse vector (fit_one_hot_vectors).
MAX_CATEGORIES = 5_000


def one(df: DataFrame) -> DataFrame:
    """Constant join key for attaching one-row results (an equi-join, never a cross join)."""
    return df.withColumn("__one", F.lit(1))


# ------------------------------------------------------------------- coercion
def fit_coercion(df: DataFrame, cols: Sequence[str]) -> dict[str, bool]:
    """O-66 fit: per column whether any row is a well-formed number (one aggregation, one boolean per column)."""
    if not cols:
        return {}
    row = df.agg(*[F.max(parse_strict(c).isNotNull()).alias(c) for c in cols]).first()
    return {c: bool(row[c]) for c in cols}


def coerce_numeric(df: DataFrame, cols: Sequence[str], strict: dict[str, bool] | None = None) -> DataFrame:
    """O-66: parse mixed numeric text; NULL → 0.0.

    Columns with a well-formed number anywhere strip ``[ ] ' "`` and parse well-formed numbers only; the others take
    the first number in the text. ``strict`` is the fitted switch, so a batch is parsed as the fit was, however the
    rows are cut into batches; without it the switch is fitted on ``df`` itself.
    """
    if not cols:
        return df
    strict = fit_coercion(df, cols) if strict is None else strict
    parsed = {c: F.coalesce(parse_strict(c) if strict.get(c) else parse_first_number(c), F.lit(0.0)) for c in cols}
    return df.select(*[parsed[c].alias(c) if c in parsed else F.col(f"`{c}`") for c in df.columns])


# -------------------------------------------------------------------- codes
def first_seen_codes(df: DataFrame, c: str, seq: str, out: str = "code") -> DataFrame:
    """O-55: integer code per distinct value in order of first appearance (``seq``).

    Returns the code table (value, code); NULL values are skipped like pandas.
    """
    first = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.min(seq).alias("__seen"))
    return row_number_by(first, [], ["__seen", c], out=out).select(c, (F.col(out) - 1).cast("long").alias(out))


def label_classes(train: DataFrame, c: str, out: str = "code") -> DataFrame:
    """O-56 fit: sorted distinct labels (as text) → 0..k-1 (``LabelEncoder.classes_``)."""
    d = train.select(F.col(c).cast("string").alias(c)).distinct()
    return row_number_by(d, [], [F.col(c).asc_nulls_first()], out=out).select(
        c, (F.col(out) - 1).cast("long").alias(out)
    )


def label_encode(df: DataFrame, classes: DataFrame, c: str, out: str = "code", strict: bool = True) -> DataFrame:
    """O-56 apply: join to the class table; unseen labels raise (strict) or get NULL."""
    x = df.withColumn("__lbl", F.col(c).cast("string"))
    cls = classes.select(F.col(c).alias("__cls"), F.col(out).alias("__code"))
    j = x.join(cls, x["__lbl"].eqNullSafe(cls["__cls"]), "left")
    if strict:
        j = j.withColumn(
            "__code",
            F.when(F.col("__code").isNull(), F.raise_error(F.concat(F.lit("unseen label: "), F.col("__lbl"))))
            .otherwise(F.col("__code")),
        )
    return j.withColumn(out, F.col("__code").cast("long")).drop("__lbl", "__cls", "__code")


# ------------------------------------------------------------------ one-hot
def fit_categories(train: DataFrame, cols: Sequence[str], max_categories: int = MAX_CATEGORIES) -> dict[str, list]:
    """Sorted distinct values per column (the one-hot vocabulary), bounded and checked."""
    out: dict[str, list] = {}
    for c in cols:
        vals = [
            r[0]
            for r in train.select(c).distinct().orderBy(F.col(c).asc_nulls_first()).limit(max_categories + 1).collect()
        ]
        if len(vals) > max_categories:
            raise ValueError(f"{c} has more than {max_categories} categories; group rare values first")
        out[c] = vals
    return out


def one_hot(df: DataFrame, categories: dict[str, list], drop_original: bool = True, prefix_sep: str = "_") -> DataFrame:
    """O-72 apply: one 0/1 double column ``<col>_<value>`` per fitted category; unseen → all zero."""
    new_cols: list[Column] = []
    for c, vals in categories.items():
        for v in vals:
            name = f"{c}{prefix_sep}{v}"
            cond = F.col(c).isNull() if v is None else (F.col(c) == F.lit(v))
            new_cols.append(F.coalesce(cond, F.lit(False)).cast("double").alias(name))
    keep = [F.col(f"`{c}`") for c in df.columns if not (drop_original and c in categories)]
    return df.select(*keep, *new_cols)


def fit_one_hot_vectors(train: DataFrame, cols: Sequence[str], out: str = "onehot") -> PipelineModel:
    """O-72 without a limit of categories: a fitted pipeline that adds one sparse vector over all of ``cols``.

    Slots follow the columns and in each its values in ascending order; a value that training did not have, and NULL,
    have none (all zero). The work a row makes grows with the number of columns, not of categories, and the vector
    goes into any estimator as it is.
    """
    cols = list(cols)
    index = StringIndexer(inputCols=cols, outputCols=[f"__i_{c}" for c in cols], handleInvalid="keep", stringOrderType="alphabetAsc")
    # the slot that "keep" adds for unknown values is the last one, which the encoder drops
    encode = OneHotEncoder(inputCols=index.getOutputCols(), outputCols=[f"__v_{c}" for c in cols], dropLast=True)
    join = VectorAssembler(inputCols=encode.getOutputCols(), outputCol=out)
    return Pipeline(stages=[index, encode, join]).fit(train)


def one_hot_vectors(df: DataFrame, model: PipelineModel, drop_original: bool = True) -> DataFrame:
    """O-72 apply: ``df`` with the fitted sparse vector, without the encoded columns."""
    cols = model.stages[0].getInputCols()
    keep = [F.col(f"`{c}`") for c in df.columns if not (drop_original and c in cols)]
    return model.transform(df).select(*keep, model.stages[-1].getOutputCol())


def vector_slots(vector: str) -> Column:
    """The non-zero (slot, value) pairs of a vector column, as an array; a sparse vector is not widened."""
    # a vector's only public form as columns is its JSON: (type, size, indices, values)
    parts = F.from_json(F.to_json(F.struct(F.col(vector).alias("v"))), "v struct<type:int,size:int,indices:array<int>,values:array<double>>")["v"]
    slots = F.coalesce(parts["indices"], F.sequence(F.lit(0), F.size(parts["values"]) - 1))
    pairs = F.zip_with(slots, parts["values"], lambda i, x: F.struct(i.alias("slot"), x.alias("value")))
    return F.filter(pairs, lambda p: p["value"] != 0)


def one_hot_slots(model: PipelineModel) -> list[tuple[str, str]]:
    """(column, value) of every slot of the fitted vector."""
    index = model.stages[0]
    return [(c, v) for c, values in zip(index.getInputCols(), index.labelsArray) for v in values]


def get_dummies(df: DataFrame, categories: dict[str, list], drop_first: bool = False, prefix_sep: str = "_") -> DataFrame:
    """O-73: boolean dummy per value with a prefix; NULL → all false; optional drop-first."""
    new_cols: list[Column] = []
    for c, vals in categories.items():
        vals = [v for v in vals if v is not None]
        for v in vals[1:] if drop_first else vals:
            new_cols.append(F.coalesce(F.col(c) == F.lit(v), F.lit(False)).alias(f"{c}{prefix_sep}{v}"))
    keep = [F.col(f"`{c}`") for c in df.columns if c not in categories]
    return df.select(*keep, *new_cols)


# ----------------------------------------------------------------- imputing
def as_category_text(c: str, dtype: str) -> Column:
    """Categorical text as pandas ``astype('string')`` writes it (booleans 'True'/'False')."""
    if dtype == "boolean":
        return F.when(F.col(c), F.lit("True")).when(~F.col(c), F.lit("False"))
    return F.col(c).cast("string")


def fit_medians(train: DataFrame, cols: Sequence[str], id_col: str | None = None) -> DataFrame:
    """O-71 fit: exact median per numeric column, long (column, median)."""
    from .profile import melt

    ids = [id_col] if id_col else []
    long = melt(train, ids, cols)
    return exact_quantiles(long, ["column"], "value", [0.5], names=["median"])


def impute(df: DataFrame, medians: dict[str, float | None], categorical: Sequence[str], fill: str = UNKNOWN) -> DataFrame:
    """O-71 apply: numeric NULL → train median (literal), categorical → text with NULL → 'unknown'."""
    dtypes = dict(df.dtypes)
    exprs = []
    for c in df.columns:
        if c in medians:
            m = medians[c]
            exprs.append(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(m).cast("double")).alias(c) if m is not None
                         else F.col(f"`{c}`").cast("double").alias(c))
        elif c in categorical:
            exprs.append(F.coalesce(as_category_text(c, dtypes[c]), F.lit(fill)).alias(c))
        else:
            exprs.append(F.col(f"`{c}`"))
    return df.select(*exprs)


# ------------------------------------------------------------- rare grouping
def fit_rare(train: DataFrame, c: str, multiplier: float = 2.0) -> DataFrame:
    """O-70 fit: values whose train frequency is below median(freq) − m·var(freq).

    Returns the rare-value table (bounded by the column's distinct count); the
    value-count table is the only thing aggregated, never the rows.
    """
    freq = train.groupBy(c).agg(F.count(F.lit(1)).cast("long").alias("count"))
    thr = frequency_threshold(freq, "count", multiplier)
    j = one(freq).join(one(thr.select("threshold")), "__one").drop("__one")
    return j.where(F.col("count") < F.col("threshold")).select(F.col(c).alias("__rare"))


def group_rare(df: DataFrame, c: str, rare: DataFrame, out: str | None = None) -> DataFrame:
    """O-70 apply: ``<c>_grouped`` = 'rare' for fitted rare values, else the value; original kept."""
    out = out or f"{c}_grouped"
    r = rare.select("__rare").distinct().withColumn("__is_rare", F.lit(True))
    j = df.join(r, df[c].eqNullSafe(r["__rare"]), "left")  # a rare NULL is grouped as well
    return j.withColumn(
        out, F.when(F.col("__is_rare"), F.lit(RARE)).otherwise(F.col(c).cast("string"))
    ).drop("__rare", "__is_rare")


def numeric_feature_frame(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """O-108: numeric and boolean columns only, boolean → 0/1, NULL → 0."""
    exprs = []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.BooleanType):
            exprs.append(F.coalesce(F.col(f"`{f.name}`").cast("long"), F.lit(0)).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            exprs.append(F.coalesce(F.col(f"`{f.name}`"), F.lit(0)).alias(f.name))
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            exprs.append(F.coalesce(F.nanvl(F.col(f"`{f.name}`").cast("double"), F.lit(None).cast("double")), F.lit(0.0)).alias(f.name))
    return df.select(*exprs)
