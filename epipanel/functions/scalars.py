"""Null-safe arithmetic used across operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num, den) -> Column:
    """num / den as double; null where den is zero or null."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def per_100k(count, population) -> Column:
    return ratio(count, population) * 100000.0


def rate_to_count(rate, population) -> Column:
    return rate * population.cast("double") / 100000.0


def fill_zero(col) -> Column:
    return F.coalesce(col.cast("double"), F.lit(0.0))


def floor_zero(col) -> Column:
    return F.when(col.isNull(), None).otherwise(F.greatest(col, F.lit(0.0)))


def null_nan(col) -> Column:
    """Model output to table value: NaN and infinities become null."""
    return F.when(F.isnan(col) | (F.abs(col) == float("inf")), None).otherwise(col)


def abs_pct_diff(left, right) -> Column:
    """|left - right| in percent of right; null where right is zero."""
    return ratio(F.abs(left - right), right) * 100.0


def box_cox(col, lam: float) -> Column:
    return F.log(col) if lam == 0 else (F.pow(col, F.lit(lam)) - 1.0) / lam


def box_cox_inverse(col, lam: float) -> Column:
    return F.exp(col) if lam == 0 else F.pow(col * lam + 1.0, F.lit(1.0 / lam))


def _shifted(x: Column, power: int, sign: float) -> tuple[Column, Column]:
    """x + 8 and the terms 1 / (x + k) ** power that lead there, times ``sign``."""
    terms = sum((F.pow(x + k, F.lit(-float(power))) for k in range(1, 8)), F.pow(x, F.lit(-float(power))))
    return x + 8.0, terms * sign


def digamma(x: Column) -> Column:
    """Derivative of the log gamma function for positive x: recurrence to x + 8, then the asymptotic series."""
    z, less = _shifted(x, 1, -1.0)
    inv = 1.0 / (z * z)
    series = inv * (1 / 12 - inv * (1 / 120 - inv * (1 / 252 - inv * (1 / 240 - inv * (1 / 132 - inv * (691 / 32760))))))
    return less + F.log(z) - 0.5 / z - series


def trigamma(x: Column) -> Column:
    """Second derivative of the log gamma function for positive x."""
    z, more = _shifted(x, 2, 1.0)
    inv = 1.0 / (z * z)
    series = inv / z * (1 / 6 - inv * (1 / 30 - inv * (1 / 42 - inv * (1 / 30 - inv * (5 / 66 - inv * (691 / 2730))))))
    return more + 1.0 / z + 0.5 * inv + series
