"""Null-safe arithmetic and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int = 6) -> Column:
    """Round half away from zero; adding 0.0 turns a negative zero into zero."""
    return F.round(value.cast("double"), digits) + F.lit(0.0)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL, not an error, over zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * F.lit(100.0)


def clipped(value: Column, low: Column | None = None, high: Column | None = None) -> Column:
    """Clip to ``[low, high]``. A NULL value stays NULL (``least``/``greatest`` alone would skip it)."""
    out = value
    if high is not None:
        out = F.least(out, high)
    if low is not None:
        out = F.greatest(out, low)
    return F.when(value.isNotNull(), out)


def flag(condition: Column) -> Column:
    """1 where true, 0 where false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def finite(value: Column) -> Column:
    """NaN and both infinities become NULL."""
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)
