"""Sunday-start week calendar."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FORMATS = ("yyyy-MM-dd",)


def as_column(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_day(col, formats=DAY_FORMATS) -> Column:
    """Text to date; anything unreadable becomes null."""
    col = as_column(col)
    tries = [F.to_date(F.try_to_timestamp(col))]
    tries += [F.to_date(F.try_to_timestamp(col, F.lit(f))) for f in formats]
    return F.coalesce(*tries)


def week_start(col) -> Column:
    """Sunday on or before a date."""
    day = F.to_date(as_column(col))
    return F.date_sub(day, F.dayofweek(day) - 1)


def iso_week(col) -> Column:
    return F.weekofyear(col)


def season_angles(day) -> dict[str, Column]:
    """Cyclic week and month features of a week-start date."""
    week = 2 * pi * F.weekofyear(day) / F.lit(53.0)
    month = 2 * pi * F.month(day) / F.lit(12.0)
    return {
        "sin_week": F.sin(week),
        "cos_week": F.cos(week),
        "sin_month": F.sin(month),
        "cos_month": F.cos(month),
    }


def fourier_terms(t, period: float, orders: int) -> dict[str, Column]:
    """sin / cos pairs of order 1..orders for a numeric time index."""
    out = {}
    for k in range(1, orders + 1):
        angle = F.lit(2 * pi * k / period) * as_column(t)
        out[f"sin_{k}"] = F.sin(angle)
        out[f"cos_{k}"] = F.cos(angle)
    return out
