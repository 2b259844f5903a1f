"""Statistical column expressions that Spark lacks as built-ins.

``normal_ppf`` is the inverse standard-normal CDF by P. J. Acklam's rational
approximation (relative error below 1.2e-9), written once as a polynomial
spec and rendered both as a Spark ``Column`` and as DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# fixed values: Acklam's inverse-normal coefficients
# ---------------------------------------------------------------------------
PPF_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
PPF_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01)
PPF_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
PPF_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
         3.754408661907416e+00)
PPF_LOW = 0.02425


def _horner(coeffs, x, lit, add, mul):
    acc = lit(coeffs[0])
    for c in coeffs[1:]:
        acc = add(mul(acc, x), lit(c))
    return acc


def normal_ppf(p: str | Column) -> Column:
    """Φ⁻¹(p) for 0 < p < 1 (NULL outside)."""
    p = F.col(p) if isinstance(p, str) else p
    lit = F.lit
    add = lambda a, b: a + b
    mul = lambda a, b: a * b

    def tail(q):
        num = _horner(PPF_C, q, lit, add, mul)
        den = add(mul(_horner(PPF_D, q, lit, add, mul), q), lit(1.0))
        return num / den

    q_lo = F.sqrt(lit(-2.0) * F.log(p))
    q_hi = F.sqrt(lit(-2.0) * F.log(lit(1.0) - p))
    q = p - lit(0.5)
    r = q * q
    central = _horner(PPF_A, r, lit, add, mul) * q / add(mul(_horner(PPF_B, r, lit, add, mul), r), lit(1.0))
    return (
        F.when((p <= 0) | (p >= 1), F.lit(None).cast("double"))
        .when(p < PPF_LOW, tail(q_lo))
        .when(p > 1 - PPF_LOW, -tail(q_hi))
        .otherwise(central)
    )


def normal_ppf_sql(p: str) -> str:
    """DuckDB twin of :func:`normal_ppf` (same operation order)."""

    def lit(v):
        return f"CAST({float(v)!r} AS DOUBLE)"

    def add(a, b):
        return f"({a} + {b})"

    def mul(a, b):
        return f"({a} * {b})"

    def tail(q):
        num = _horner(PPF_C, q, lit, add, mul)
        den = add(mul(_horner(PPF_D, q, lit, add, mul), q), lit(1.0))
        return f"({num} / {den})"

    q_lo = f"sqrt({lit(-2.0)} * ln({p}))"
    q_hi = f"sqrt({lit(-2.0)} * ln({lit(1.0)} - {p}))"
    q = f"({p} - {lit(0.5)})"
    r = f"({q} * {q})"
    central = f"({_horner(PPF_A, r, lit, add, mul)} * {q} / {add(mul(_horner(PPF_B, r, lit, add, mul), r), lit(1.0))})"
    return (
        f"CASE WHEN {p} <= 0 OR {p} >= 1 THEN NULL WHEN {p} < {PPF_LOW!r} THEN {tail(q_lo)} "
        f"WHEN {p} > {1 - PPF_LOW!r} THEN -{tail(q_hi)} ELSE {central} END"
    )


def filliben_position(i: Column, n: Column) -> Column:
    """Filliben's order-statistic medians used by normal probability plots."""
    last = F.pow(F.lit(0.5), F.lit(1.0) / n)
    return (
        F.when(i == n, last)
        .when(i == 1, F.lit(1.0) - last)
        .otherwise((i - F.lit(0.3175)) / (n + F.lit(0.365)))
    )
