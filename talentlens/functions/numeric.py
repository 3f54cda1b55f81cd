"""Numeric helpers with pinned rounding/format semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(c: Column, decimals: int) -> Column:
    """numpy-style round: ``rint(x * 10^d) / 10^d`` (half-even on the scaled value)."""
    scale = float(10 ** decimals)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def clip(c: Column, lo=None, hi=None) -> Column:
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return out


def ladder(value: Column, steps, default) -> Column:
    """``value <= bound_i → score_i`` for the first matching step."""
    expr = None
    for bound, score in steps:
        cond = value <= F.lit(bound)
        expr = F.when(cond, F.lit(score)) if expr is None else expr.when(cond, F.lit(score))
    return expr.otherwise(F.lit(default))


SPLIT = 134217729.0   # 2^27 + 1 (Veltkamp split)


def scaled_half_even(c: Column, scale: float) -> Column:
    """Integer nearest to the *exact* ``x·scale`` (ties to even), for small integer ``scale``.

    ``p = x·scale`` is rounded; its rounding error ``e`` is recovered exactly
    (Dekker product with a 26-bit split of x), and only when ``p`` lands on a
    .5 tie does ``e`` decide the direction.  This is how Python formats a
    double ("%.1f" of 0.35 is "0.3" because 0.35 is stored as 0.3499…).
    """
    s = F.lit(float(scale))
    t = c * F.lit(SPLIT)
    hi = t - (t - c)
    lo = c - hi
    p = c * s
    e = (hi * s - p) + lo * s
    tie = (p - F.floor(p)) == F.lit(0.5)
    return (F.when(tie & (e > 0), F.ceil(p)).when(tie & (e < 0), F.floor(p))
             .otherwise(F.rint(p))).cast("double")


def fmt_one_decimal(c: Column) -> Column:
    """``f"{x:.1f}"``: exact half-even tenths, then '%.1f' of k/10."""
    return F.format_string("%.1f", scaled_half_even(c, 10) / F.lit(10.0))


def fmt_percent(c: Column) -> Column:
    """``f"{x:.0%}"``: Python multiplies by 100 in double first, then rounds half-even."""
    return F.concat(F.rint(c * F.lit(100.0)).cast("long").cast("string"), F.lit("%"))


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))
