"""Numeric column functions: coercion, clipping and the two power families."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellweft.functions.text import na_to_null


def to_number(value: Column) -> Column:
    """Text to double; anything that does not parse is NULL."""
    return na_to_null(value.cast("string")).try_cast("double")


def finite_or_null(value: Column) -> Column:
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def finite_or_zero(value: Column) -> Column:
    return F.coalesce(finite_or_null(value), F.lit(0.0))


def fill_zero(value: Column) -> Column:
    return F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0))


def raise_to(value: Column, threshold: Column | float) -> Column:
    """Values below the threshold become the threshold."""
    limit = F.lit(float(threshold)) if isinstance(threshold, (int, float)) else threshold
    return F.greatest(value, limit)


def boxcox(value: Column, lam: float) -> Column:
    """Box-Cox of a positive value."""
    if abs(lam) < 1e-12:
        return F.ln(value)
    return (F.pow(value, F.lit(float(lam))) - 1.0) / F.lit(float(lam))


def yeo_johnson(value: Column, lam: float) -> Column:
    up = F.log1p(value) if abs(lam) < 1e-12 else (F.pow(value + 1.0, F.lit(float(lam))) - 1.0) / F.lit(float(lam))
    mirror = 2.0 - lam
    down = (-F.log1p(-value) if abs(mirror) < 1e-12
            else -(F.pow(1.0 - value, F.lit(float(mirror))) - 1.0) / F.lit(float(mirror)))
    return F.when(value >= 0, up).otherwise(down)


def signed_log(value: Column) -> Column:
    return F.signum(value) * F.log1p(F.abs(value))
