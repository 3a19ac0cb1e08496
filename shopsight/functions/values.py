"""Null-safe numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_DAY = 86_400_000_000


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clip(value: Column | str, low, high) -> Column:
    """Clamp to [low, high]; a null stays null (greatest/least alone would return a bound)."""
    value = as_column(value)
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.when(value.isNotNull(), F.greatest(low, F.least(high, value)))


def finite(value: Column | str) -> Column:
    """NaN and infinities become null."""
    value = as_column(value).cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def elapsed_days(later: Column | str, earlier: Column | str) -> Column:
    """Fractional days between two timestamps."""
    return (F.unix_micros(as_column(later)) - F.unix_micros(as_column(earlier))) / F.lit(float(MICROS_PER_DAY))


def whole_days(later: Column | str, earlier: Column | str) -> Column:
    """Completed 24-hour periods, not calendar days."""
    return F.floor(elapsed_days(later, earlier)).cast("long")


def flag(condition: Column) -> Column:
    """1 when true; 0 when false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def log1p(value: Column | str) -> Column:
    return F.log1p(as_column(value))


def expm1(value: Column | str) -> Column:
    return F.expm1(as_column(value))


def right_closed_bins(value: Column | str, edges: list[float], labels: list[str], include_lowest: bool = False) -> Column:
    """Label of the interval (edge, next edge] that holds the value; null outside."""
    value = as_column(value)
    expr = None
    for i, label in enumerate(labels):
        above = value >= edges[i] if include_lowest and i == 0 else value > edges[i]
        inside = above & (value <= edges[i + 1])
        expr = F.when(inside, label) if expr is None else expr.when(inside, label)
    return expr
