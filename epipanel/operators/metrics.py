"""Accuracy and interval metrics of a prediction table, as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epipanel.functions.scalars import ratio
from epipanel.session import require_columns

FLAT_VARIANCE = 1e-8
Y, P = "cases", "prediction"


def r2(y=Y, p=P) -> Column:
    """1 - SSE / SST; null for fewer than two rows or a flat series."""
    y, p = F.col(y), F.col(p)
    total = F.var_pop(y) * F.count(y)
    fit = F.lit(1.0) - F.try_divide(F.sum(F.pow(y - p, F.lit(2.0))), total)
    return F.when((F.count(y) >= 2) & (F.var_pop(y) > FLAT_VARIANCE), fit)


def mae(y=Y, p=P) -> Column:
    return F.avg(F.abs(F.col(y) - F.col(p)))


def rmse(y=Y, p=P) -> Column:
    return F.sqrt(F.avg(F.pow(F.col(y) - F.col(p), F.lit(2.0))))


def mape(y=Y, p=P) -> Column:
    y, p = F.col(y), F.col(p)
    return F.avg(F.when(y > 0, F.abs(y - p) / y * 100.0))


def smape(y=Y, p=P) -> Column:
    y, p = F.col(y), F.col(p)
    return F.avg(F.abs(y - p) * 200.0 / (F.abs(y) + F.abs(p) + 1e-8))


def _in_band(y, lower, upper) -> Column:
    y, lo, hi = F.col(y), F.col(lower), F.col(upper)
    complete = y.isNotNull() & lo.isNotNull() & hi.isNotNull()
    return F.when(complete, ((y >= lo) & (y <= hi)).cast("double"))


def coverage(y=Y, lower="lower_ci", upper="upper_ci") -> Column:
    """Share of complete rows inside the closed band."""
    return F.avg(_in_band(y, lower, upper))


def interval_score(alpha: float = 0.10, y=Y, lower="lower_ci", upper="upper_ci") -> Column:
    """Mean one-interval weighted interval score (Winkler form)."""
    y, lo, hi = F.col(y), F.col(lower), F.col(upper)
    short = F.greatest(lo - y, F.lit(0.0))
    excess = F.greatest(y - hi, F.lit(0.0))
    complete = y.isNotNull() & lo.isNotNull() & hi.isNotNull()
    return F.avg(F.when(complete, (hi - lo) + F.lit(2.0 / alpha) * (short + excess)))


def calibration_error(cover: Column, alpha: float = 0.10) -> Column:
    return F.abs(cover - F.lit(1.0 - alpha))


def interval_coverage(df: DataFrame, strict: bool = True, lower="lower_ci", upper="upper_ci") -> DataFrame:
    """One-row coverage; without bands either raise or give null."""
    if strict:
        require_columns(df, Y, lower, upper)
    elif not {lower, upper} <= set(df.columns):
        return df.agg(F.lit(None).cast("double").alias("coverage"))
    return df.agg(coverage(Y, lower, upper).alias("coverage"))


def weekly_totals(df: DataFrame, *dims: str, week: str = "epi_sunday") -> DataFrame:
    return df.groupBy(*dims, week).agg(F.sum(Y).alias(Y), F.sum(P).alias(P))


def point_metrics(totals: DataFrame, *dims: str, peak: float = 0.75) -> DataFrame:
    """R2, MAE, RMSE, MAPE, sMAPE, peak threshold and peak hit rate.

    ``totals`` holds one row per week and group, so the collected pairs behind
    the hit rate are bounded by the calendar and one pass is enough.
    """
    agg = totals.groupBy(*dims).agg(
        r2().alias("r2"),
        mae().alias("mae"),
        rmse().alias("rmse"),
        mape().alias("mape"),
        smape().alias("smape"),
        F.percentile(Y, F.lit(peak)).alias("peak_value"),
        F.collect_list(F.struct(F.col(Y).alias("y"), F.col(P).alias("p"))).alias("_pairs"),
    )
    top = F.col("peak_value")
    real = F.filter("_pairs", lambda x: x["y"] >= top)
    both = F.filter(real, lambda x: x["p"] >= top)
    return agg.withColumn("hit_rate", ratio(F.size(both), F.size(real))).drop("_pairs")


def region_metrics(df: DataFrame, *dims: str, alpha: float = 0.10) -> DataFrame:
    """Point metrics per region; coverage and interval score too where there are bands."""
    bands = {"lower_ci", "upper_ci"} <= set(df.columns)
    more = [coverage().alias("coverage_ra"), interval_score(alpha).alias("wis_ra")] if bands else []
    return df.groupBy(*dims, "ra").agg(r2().alias("r2_ra"), mae().alias("mae_ra"), rmse().alias("rmse_ra"), *more)


def consolidated(df: DataFrame, *dims: str, peak: float = 0.75, alpha: float = 0.10) -> DataFrame:
    """One row per group: totals' point metrics, row-level band metrics and the
    null-skipping means of the per-region metrics."""
    require_columns(df, "epi_sunday", "ra", Y, P)
    point = point_metrics(weekly_totals(df, *dims), *dims, peak=peak)
    regions = region_metrics(df, *dims).groupBy(*dims).agg(
        F.avg("r2_ra").alias("r2_mean_ra"),
        F.avg("mae_ra").alias("mae_mean_ra"),
        F.avg("rmse_ra").alias("rmse_mean_ra"),
    )
    if {"lower_ci", "upper_ci"} <= set(df.columns):
        bands = df.groupBy(*dims).agg(
            coverage().alias("coverage"), interval_score(alpha).alias("wis")
        ).withColumn("calibration_error", calibration_error(F.col("coverage"), alpha))
    else:
        blank = F.lit(None).cast("double")
        bands = df.select(*dims).distinct() if dims else df.agg(F.count("*").alias("_rows")).drop("_rows")
        bands = bands.select(
            *dims, blank.alias("coverage"), blank.alias("wis"), blank.alias("calibration_error")
        )
    keys = list(dims)
    if not keys:
        point, regions, bands = (f.withColumn("_one", F.lit(1)) for f in (point, regions, bands))
        keys = ["_one"]
    return point.join(bands, keys).join(regions, keys).drop("_one")


def level_mape(df: DataFrame, models: list[str], level: str = "level") -> DataFrame:
    """MAPE (as a share) per level and model column, plus the overall row."""
    long = df.unpivot([level, "unique_id", "ds", "y"], models, "model", "yhat")
    err = F.abs(F.col("y") - F.col("yhat")) / F.when(F.col("y") != 0, F.abs(F.col("y")))
    per_series = long.groupBy(level, "unique_id", "model").agg(F.avg(err).alias("_m"))
    name = F.when(F.grouping(level) == 1, F.lit("overall")).otherwise(F.col(level).cast("string"))
    sets = per_series.groupingSets([[level, "model"], ["model"]], level, "model").agg(name.alias("_name"), F.avg("_m").alias("mape"))
    return sets.select(F.col("_name").alias(level), "model", "mape")
