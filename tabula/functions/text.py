"""Text and boolean column functions (JVM-side expressions)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token sets that must equal the reference's for the same booleans.
QC_POSITIVE_TOKENS = ("positive", "+", "yes", "1")  # quality profiling and target building
CAST_POSITIVE_TOKENS = ("positive", "+")  # boolean cast during training preprocessing
LABEL_POSITIVE_TOKENS = ("yes", "positive", "+", "1", "true")  # readable multi-label target
TRUE_FALSE_TOKENS = ("true", "false")
UNKNOWN = "unknown"
RARE = "rare"
NONE_LABEL = "none"
LABEL_SEPARATOR = "|"
TEXT_JOIN_SEPARATOR = "||"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c: str | Column) -> Column:
    """O-61: trim + lower case, NULL kept."""
    return F.lower(F.trim(col(c).cast("string")))


def token_boolean(c: str | Column, tokens: Iterable[str] = QC_POSITIVE_TOKENS) -> Column:
    """O-63: normalised text in the positive token set → true, other text → false, NULL kept."""
    n = normalize_text(c)
    return F.when(n.isNull(), F.lit(None).cast("boolean")).otherwise(n.isin(list(tokens)))


def target_boolean(c: str | Column, tokens: Iterable[str] = QC_POSITIVE_TOKENS) -> Column:
    """O-64: like O-63 but NULL becomes false (the reference stringifies NULL to 'nan' first).

    Numbers are stringified as the reference does: 1 → '1' (true), 1.0 → '1.0' (false).
    """
    return F.coalesce(normalize_text(c).isin(list(tokens)), F.lit(False))


def true_false_cast(c: str | Column) -> Column:
    """O-65: 'true'/'false' text (any case, blanks) → boolean, NULL kept."""
    n = normalize_text(c)
    return F.when(n.isNull(), F.lit(None).cast("boolean")).otherwise(n == F.lit("true"))


def presence_flag(c: str | Column) -> Column:
    """O-75: not NULL → true."""
    return col(c).isNotNull()


def sanitize_name(c: str | Column) -> Column:
    """O-79: trim, lower, blank and both slashes → underscore."""
    return F.translate(F.lower(F.trim(col(c).cast("string"))), " /\\", "___")


def join_text_columns(cols: Sequence[str | Column], sep: str = TEXT_JOIN_SEPARATOR) -> Column:
    """O-78: values as text joined by ``sep``; NULL is written as 'nan' like the reference."""
    return F.concat_ws(sep, *[F.coalesce(col(c).cast("string"), F.lit("nan")) for c in cols])


def is_positive_value(c: str | Column, tokens: Iterable[str] = LABEL_POSITIVE_TOKENS) -> Column:
    """Positive flag for label building: booleans as is; text by token set; NULL → false."""
    return F.coalesce(normalize_text(c).isin(list(tokens)), F.lit(False))


def active_label_string(
    dummy_cols: Sequence[str],
    flag_cols: Sequence[str],
    strip_prefix: str = "",
    sep: str = LABEL_SEPARATOR,
    empty: str = NONE_LABEL,
) -> Column:
    """O-74: names of the active labels joined by ``sep``; ``empty`` if none.

    A dummy column is active when it equals 1 (its name loses ``strip_prefix``);
    a flag column is active when :func:`is_positive_value` holds.
    """
    parts = [F.when(col(c).cast("double") == 1, F.lit(c.replace(strip_prefix, "", 1) if strip_prefix else c)) for c in dummy_cols]
    parts += [F.when(is_positive_value(c), F.lit(c)) for c in flag_cols]
    joined = F.concat_ws(sep, *parts) if parts else F.lit("")
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit(empty))
