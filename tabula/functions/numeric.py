"""Numeric column functions (all JVM-side expressions, no Python UDFs)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strict numeric literal accepted by the coercion main path, and
# the first-number pattern of its fallback.
STRICT_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
FIRST_NUMBER = r"([-+]?\d*\.?\d+([eE][-+]?\d+)?)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r6(c: str | Column, digits: int = 6) -> Column:
    """Round for cross-engine comparison; ``+ 0.0`` turns -0.0 into 0.0."""
    return (F.round(col(c).cast("double"), digits) + F.lit(0.0)).cast("double")


def non_finite_to_null(c: str | Column) -> Column:
    """O-82: NaN and ±inf → NULL."""
    x = col(c).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(x)


def threshold_small(c: str | Column, t: float = 1.5) -> Column:
    """O-68: keep x where abs(x) > t, else 0 (NULL → 0 as well)."""
    x = col(c)
    return F.when(F.abs(x) > F.lit(t), x).otherwise(F.lit(0.0)).cast("double")


def unwrap_singleton(c: str | Column) -> Column:
    """O-67: array of one → its element, empty array → NULL, longer arrays kept (as text)."""
    a = col(c)
    return (
        F.when(F.size(a) == 1, F.element_at(a, 1).cast("string"))
        .when(F.size(a) == 0, F.lit(None).cast("string"))
        .otherwise(F.to_json(a))
    )


def strip_numeric_text(c: str | Column) -> Column:
    """Remove ``[ ] ' "`` and outer blanks (list-like numeric text such as ``['7.4E-3']``)."""
    return F.trim(F.translate(col(c).cast("string"), "[]'\"", ""))


def parse_strict(c: str | Column) -> Column:
    """Strict numeric parse: only well-formed decimal/scientific literals, else NULL."""
    s = strip_numeric_text(c)
    return F.when(s.rlike(STRICT_NUMBER), s.try_cast("double"))


def parse_first_number(c: str | Column) -> Column:
    """Fallback parse: the first number-like token anywhere in the text."""
    s = strip_numeric_text(c)
    tok = F.regexp_extract(s, FIRST_NUMBER, 1)
    return F.when(tok != "", tok.try_cast("double"))


def cut_bins(c: str | Column, edges: list[float], labels: list[str]) -> Column:
    """O-62: left-closed bins [e0,e1) … with labels; outside all bins → NULL."""
    x = col(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x >= F.lit(lo)) & (x < F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def normal_cdf(z: Column) -> Column:
    """Φ(z) with the Abramowitz–Stegun 7.1.26 erf approximation (abs error < 1.5e-7).

    Spark SQL has no ``erf``; the same polynomial is written in the oracle SQL.
    """
    # A&S 7.1.26 coefficients.
    p = 0.3275911
    a1, a2, a3, a4, a5 = 0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429
    x = F.abs(z) / F.lit(math.sqrt(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(p) * x)
    poly = ((((F.lit(a5) * t + F.lit(a4)) * t + F.lit(a3)) * t + F.lit(a2)) * t + F.lit(a1)) * t
    erf_abs = F.lit(1.0) - poly * F.exp(-x * x)
    return F.when(z >= 0, F.lit(0.5) * (F.lit(1.0) + erf_abs)).otherwise(F.lit(0.5) * (F.lit(1.0) - erf_abs))


def normal_cdf_sql(z: str) -> str:
    """Same approximation as DuckDB/Spark SQL text (used by oracles)."""
    x = f"(abs({z}) / sqrt(2.0))"
    t = f"(1.0 / (1.0 + 0.3275911 * {x}))"
    poly = (
        f"(((((1.061405429 * {t} + -1.453152027) * {t} + 1.421413741) * {t} + -0.284496736) * {t}"
        f" + 0.254829592) * {t})"
    )
    e = f"(1.0 - {poly} * exp(-({x}) * ({x})))"
    return f"(CASE WHEN {z} >= 0 THEN 0.5 * (1.0 + {e}) ELSE 0.5 * (1.0 - {e}) END)"


def kolmogorov_p(d: Column, n: Column, terms: int = 30) -> Column:
    """Asymptotic KS p-value: λ = (√n + 0.12 + 0.11/√n)·D; p = 2Σ(−1)^{j−1}e^{−2j²λ²}, in [0, 1].

    The series is cut at 30 terms: for λ ≥ 0.2 (smaller λ gives p = 1) the next
    term is below e^(−74), so the sum equals the 100-term sum in double precision.
    """
    sn = F.sqrt(n.cast("double"))
    lam = (sn + F.lit(0.12) + F.lit(0.11) / sn) * d
    s = None
    for j in range(1, terms + 1):
        term = F.lit(2.0 * (1 if j % 2 == 1 else -1)) * F.exp(F.lit(-2.0 * j * j) * lam * lam)
        s = term if s is None else s + term
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), s)))


def kolmogorov_p_sql(d: str, n: str, terms: int = 30) -> str:
    lam = f"((sqrt({n}) + 0.12 + 0.11 / sqrt({n})) * {d})"
    parts = [f"{2.0 * (1 if j % 2 == 1 else -1)} * exp({-2.0 * j * j} * {lam} * {lam})" for j in range(1, terms + 1)]
    s = " + ".join(parts)
    return f"(CASE WHEN {lam} < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, {s})) END)"
