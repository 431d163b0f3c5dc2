"""Guarded arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or(numerator: Column, denominator: Column, default: float) -> Column:
    """``numerator / denominator``; ``default`` when the denominator is 0 or null."""
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(default))


def change_or_zero(value: Column, base: Column) -> Column:
    """Relative change against ``base``; 0 when there is no usable base."""
    return ratio_or(value - base, base, 0.0)


def present(value: Column) -> Column:
    """Whether there is a number: neither null nor NaN."""
    return value.isNotNull() & ~F.isnan(value)


def clamp(value: Column, limit: float) -> Column:
    """``value`` held between ``-limit`` and ``limit``; a missing one (null, NaN) becomes null."""
    return F.when(present(value), F.greatest(F.lit(-limit), F.least(F.lit(limit), value)))


def truncate(value: Column) -> Column:
    """Drop the fraction (towards zero)."""
    return value.cast("int")


def weighted_sum(columns: list[str], weights: list[float], intercept: float) -> Column:
    """Dot product written out so that it stays inside generated code."""
    total = F.lit(float(intercept))
    for name, weight in zip(columns, weights, strict=True):
        total = total + F.col(name) * F.lit(float(weight))
    return total
