"""Calendar features of a timestamp."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from shopsight.functions.values import as_column, flag, right_closed_bins


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    """Position on a circle, so that the last value of a period is close to the first."""
    angle = value * F.lit(2.0 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def calendar_columns(ts: Column | str) -> dict[str, Column]:
    ts = as_column(ts)
    hour, weekday, day = F.hour(ts), F.weekday(ts), F.dayofmonth(ts)
    hour_sin, hour_cos = cyclic(hour, 24)
    week_sin, week_cos = cyclic(weekday, 7)
    return {
        "order_hour": hour,
        "order_dayofweek": weekday,
        "order_month": F.month(ts),
        "order_day": day,
        "order_quarter": F.quarter(ts),
        "is_weekend": flag(weekday >= 5),
        "is_month_start": flag(day <= 7),
        "is_month_end": flag(day >= 24),
        "order_hour_sin": hour_sin,
        "order_hour_cos": hour_cos,
        "order_dayofweek_sin": week_sin,
        "order_dayofweek_cos": week_cos,
    }


def month_cycle(ts: Column | str) -> dict[str, Column]:
    month_sin, month_cos = cyclic(F.month(as_column(ts)), 12)
    return {"order_month_sin": month_sin, "order_month_cos": month_cos}


def time_of_day(hour: Column | str) -> Column:
    """Day parts closed on the right, midnight included in the first."""
    return right_closed_bins(
        hour, [0, 6, 12, 18, 24], ["night", "morning", "afternoon", "evening"], include_lowest=True
    )


def add_calendar_features(df: DataFrame, ts: str = "order_purchase_timestamp") -> DataFrame:
    return df.withColumns(calendar_columns(ts))
