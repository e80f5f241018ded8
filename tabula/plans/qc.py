"""Quality-control profile and recommendations (O-26, O-28..O-31, O-33) as one job set.

Every profile is an aggregation whose result has one row per column; the
recommendation lines are built from those small frames with SQL functions, so
the only driver-side values are the final text lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import QC_POSITIVE_TOKENS
from ..operators.profile import boolean_candidates, cardinality_profile, duplicate_count, iqr_profile, null_profile
from ..operators.relational import categorical_columns, numeric_columns
from .preprocess import PrepSpec

# Recommendation texts of the quality report ({} = filled in).
HEADER = "Recommended preprocessing strategy based on QC:"
DUP_YES = "- Remove or review {n} duplicate rows based on {id}."
DUP_NO = "- No duplicate row cleanup required."
MISSING_YES = "- Impute or handle missing values in columns: {cols}."
MISSING_NO = "- No missing-value imputation required."
OUTLIER_YES = "- Consider robust scaling/capping for outliers in: {cols}."
OUTLIER_NO = "- No strong outlier treatment indicated by IQR rule."
CARD_YES = "- High-cardinality categorical columns detected ({cols}); consider target/frequency encoding."
CARD_NO = "- Categorical cardinality is manageable for standard encoding."
BOOL_YES = "- Converted to boolean: {cols}."
BOOL_NO = "- No categorical columns met the boolean-cast rule."
HIGH_CARDINALITY = 20


def _names_in_order(df: DataFrame, flag: str, positions: dict[str, int]) -> DataFrame:
    """One row: the flagged column names joined by ', ' in table order (≤ #columns rows aggregated)."""
    pos = F.create_map(*[x for k, v in positions.items() for x in (F.lit(k), F.lit(v))])
    picked = df.where(F.col(flag)).select(F.struct(F.element_at(pos, F.col("column")).alias("p"), "column").alias("s"))
    return picked.agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda x: x["column"]), ", ").alias("names")
    )


def _line(names: DataFrame, yes: str, no: str) -> Column:
    return F.when(F.length(F.col("names")) > 0, F.replace(F.lit(yes), F.lit("{cols}"), F.col("names"))).otherwise(F.lit(no))


def qc_recommendations(df: DataFrame, id_col: str, tokens=QC_POSITIVE_TOKENS) -> DataFrame:
    """O-33: (line_no, text) recommendation lines followed by the summary lines."""
    spark = df.sparkSession
    positions = {c: i for i, c in enumerate(df.columns)}
    num = numeric_columns(df)
    cat = categorical_columns(df)
    one = F.lit(1).alias("__one")

    dup = duplicate_count(df, id_col).select("duplicates", one)
    miss = _names_in_order(null_profile(df), "has_nulls", positions).select("names", one)
    out = _names_in_order(iqr_profile(df, id_col, num), "has_outliers", positions).select("names", one) if num else None
    card = cardinality_profile(df, cat, HIGH_CARDINALITY) if cat else None
    boo = boolean_candidates(df, cat, tokens) if cat else None

    lines: list[DataFrame] = [spark.range(1).select(F.lit(0).alias("line_no"), F.lit(HEADER).alias("text"))]
    lines.append(dup.select(F.lit(1).alias("line_no"), F.when(
        F.col("duplicates") > 0,
        F.replace(F.replace(F.lit(DUP_YES), F.lit("{n}"), F.col("duplicates").cast("string")), F.lit("{id}"), F.lit(id_col)),
    ).otherwise(F.lit(DUP_NO)).alias("text")))
    lines.append(miss.select(F.lit(2).alias("line_no"), _line(miss, MISSING_YES, MISSING_NO).alias("text")))
    if out is not None:
        lines.append(out.select(F.lit(3).alias("line_no"), _line(out, OUTLIER_YES, OUTLIER_NO).alias("text")))
    else:
        lines.append(spark.range(1).select(F.lit(3).alias("line_no"), F.lit(OUTLIER_NO).alias("text")))
    if card is not None:
        c = _names_in_order(card, "high_cardinality", positions)
        b = _names_in_order(boo, "is_boolean_candidate", positions)
        lines.append(c.select(F.lit(4).alias("line_no"), _line(c, CARD_YES, CARD_NO).alias("text")))
        lines.append(b.select(F.lit(5).alias("line_no"), _line(b, BOOL_YES, BOOL_NO).alias("text")))
    else:
        lines.append(spark.range(1).select(F.lit(4).alias("line_no"), F.lit(CARD_NO).alias("text")))
        lines.append(spark.range(1).select(F.lit(5).alias("line_no"), F.lit(BOOL_NO).alias("text")))
    n = df.agg(F.count(F.lit(1)).alias("n"))
    lines.append(n.select(F.lit(6).alias("line_no"), F.concat(F.lit("Rows: "), F.col("n").cast("string")).alias("text")))
    lines.append(spark.range(1).select(F.lit(7).alias("line_no"), F.lit(f"Columns: {len(df.columns)}").alias("text")))
    lines.append(dup.select(F.lit(8).alias("line_no"),
                            F.concat(F.lit(f"Duplicate rows by {id_col}: "), F.col("duplicates").cast("string")).alias("text")))
    lines.append(spark.range(1).select(F.lit(9).alias("line_no"),
                                       F.lit(f"Numeric columns checked for outliers: {len(num)}").alias("text")))
    lines.append(spark.range(1).select(F.lit(10).alias("line_no"),
                                       F.lit(f"Categorical columns checked for cardinality: {len(cat)}").alias("text")))
    res = lines[0]
    for x in lines[1:]:
        res = res.unionByName(x)
    return res.withColumn("line_no", F.col("line_no").cast("long"))


def qc_flags(df: DataFrame, id_col: str, tokens=QC_POSITIVE_TOKENS) -> dict:
    """The four QC outputs used downstream (duplicates?, boolean, outlier, high-cardinality columns).

    Small per-column results only reach the driver.
    """
    num = numeric_columns(df)
    cat = categorical_columns(df)
    has_dup = duplicate_count(df, id_col).first()["duplicates"] > 0
    outl = [r["column"] for r in iqr_profile(df, id_col, num).where("has_outliers").collect()] if num else []
    high = [r["column"] for r in cardinality_profile(df, cat, HIGH_CARDINALITY).where("high_cardinality").collect()] if cat else []
    boo = [r["column"] for r in boolean_candidates(df, cat, tokens).where("is_boolean_candidate").collect()] if cat else []
    order = {c: i for i, c in enumerate(df.columns)}
    return {
        "has_duplicates": bool(has_dup),
        "boolean_cast_columns": sorted(boo, key=order.get),
        "outlier_columns": sorted(outl, key=order.get),
        "high_cardinality_columns": sorted(high, key=order.get),
    }


def spec_from_qc(df: DataFrame, id_col: str, cohort_col: str, targets: Sequence[str], task: str = "regression",
                 signal_cols: Sequence[str] = (), seq_col: str | None = None, tokens=QC_POSITIVE_TOKENS) -> PrepSpec:
    """The preprocessing settings that quality control finds on ``df``: whether first rows per id are to be taken (in
    the order of ``seq_col``, without which a fit on repeated ids is refused), and the columns to cast to boolean, to clip
    and to group rare values of. Id, cohort and targets are never among them."""
    flags = qc_flags(df, id_col, tokens)
    own = {id_col, cohort_col, *targets}
    cols = {k: [c for c in flags[k] if c not in own] for k in ("boolean_cast_columns", "outlier_columns", "high_cardinality_columns")}
    return PrepSpec(
        id_col=id_col, cohort_col=cohort_col, targets=list(targets), signal_cols=list(signal_cols),
        has_duplicates=flags["has_duplicates"], seq_col=seq_col, task=task, **cols,
    )
