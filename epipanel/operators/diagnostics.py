"""Series diagnostics and benchmark forecasts, as window jobs per series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epipanel.functions.scalars import ratio
from epipanel.operators.ranks import constant_level, quantiles, value_counts
from epipanel.operators.series import ordered


def benchmark_forecasts(df: DataFrame, keys: list[str], order: str, col: str, season: int = 52) -> DataFrame:
    """One-step naive, seasonal naive, mean and drift from earlier rows only."""
    w = ordered(keys, order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    n = F.row_number().over(w) - 1
    last, first = F.lag(col).over(w), F.first(col).over(before)
    slope = F.try_divide(last - first, (n - 1).cast("double"))
    return df.withColumns(
        {
            "naive": last,
            "seasonal_naive": F.lag(col, season).over(w),
            "mean": F.avg(col).over(before),
            "drift": last + slope,
        }
    )


def mase(df: DataFrame, keys: list[str], order: str, col: str, prediction: str, season: int = 52) -> DataFrame:
    """Mean absolute error scaled by the seasonal-naive error of the same rows,
    overall and for rows above and up to the 75th percentile of the whole series."""
    w = ordered(keys, order)
    scaled = df.withColumns(
        {"_e": F.abs(F.col(col) - F.col(prediction)), "_s": F.abs(F.col(col) - F.lag(col, season).over(w))}
    ).filter("_e is not null and _s is not null")
    cut = quantiles(value_counts(df, keys, col), keys, col, {"_cut": constant_level(0.75)}).drop("n")
    high = F.col(col) > F.col("_cut")
    return scaled.join(cut, keys).groupBy(*keys).agg(
        ratio(F.avg("_e"), F.avg("_s")).alias("mase"),
        ratio(F.avg(F.when(high, F.col("_e"))), F.avg("_s")).alias("mase_high"),
        ratio(F.avg(F.when(~high, F.col("_e"))), F.avg("_s")).alias("mase_low"),
    )


def quantile_score(df: DataFrame, y: str, bands: dict[float, str], weights: dict[float, float] | None = None):
    """Twice the weighted mean pinball loss over several quantile columns."""
    terms, total = [], 0.0
    for q, c in bands.items():
        weight = (weights or {}).get(q, 1.0)
        total += weight
        gap = F.col(y) - F.col(c)
        terms.append(F.greatest(gap * q, gap * (q - 1.0)) * weight)
    pinball = sum(terms[1:], terms[0])
    return F.avg(pinball * (2.0 / total))


def autocorrelation(df: DataFrame, keys: list[str], order: str, col: str, max_lag: int) -> DataFrame:
    """(keys, n, lag, acf) for lag 0..max_lag."""
    return cross_correlation(df, keys, order, col, col, max_lag).withColumnRenamed("ccf", "acf")


def cross_correlation(df: DataFrame, keys: list[str], order: str, lead: str, col: str, max_lag: int) -> DataFrame:
    """Correlation of ``col[t]`` with ``lead[t - lag]`` for lag 0..max_lag, scaled
    by the full-length deviations as a correlogram is.

    A series becomes one row with two arrays, no longer than the calendar; each
    lag is a fold over their overlap, so one aggregate does for all lags.
    """
    points = F.sort_array(F.collect_list(F.struct(order, F.col(lead).cast("double").alias("x"), F.col(col).cast("double").alias("y"))))
    series = df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg(lead).alias("_mx"), F.avg(col).alias("_my"), points.alias("_s")
    ).select(
        *keys, "n", F.transform("_s", lambda p: p["x"] - F.col("_mx")).alias("_x"), F.transform("_s", lambda p: p["y"] - F.col("_my")).alias("_y")
    )

    def dot(a: Column, b: Column) -> Column:
        products = F.zip_with(a, b, lambda u, v: F.coalesce(u * v, F.lit(0.0)))
        return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)

    def overlap(k: Column) -> Column:
        size = F.greatest(F.size("_y") - k, F.lit(0))
        return dot(F.slice("_y", k + 1, size), F.slice("_x", F.lit(1), size))

    scale = F.sqrt(dot(F.col("_x"), F.col("_x")) * dot(F.col("_y"), F.col("_y")))
    lags = F.transform(F.sequence(F.lit(0), F.lit(max_lag)), lambda k: F.struct(k.alias("lag"), overlap(k).alias("_p"), (k < F.size("_y")).alias("_any")))
    return series.select(*keys, "n", scale.alias("_scale"), F.inline(lags)).select(
        *keys, "n", "lag", F.when(F.col("_any"), F.try_divide("_p", "_scale")).alias("ccf")
    )


def ljung_box(acf: DataFrame, keys: list[str]) -> DataFrame:
    """Q = n (n + 2) sum r_k^2 / (n - k) over the positive lags."""
    n, k, r = F.col("n"), F.col("lag"), F.col("acf")
    return acf.filter("lag > 0").groupBy(*keys).agg(
        (F.max(n) * (F.max(n) + 2) * F.sum(r * r / (n - k))).alias("q"), F.max("lag").alias("lags")
    )


def count_profile(df: DataFrame, keys: list[str], y: str) -> DataFrame:
    """Mean level, dispersion, zero share and the model family they suggest.

    More than a fifth of zeros asks for a zero-inflated model below ten cases a
    week and for a hurdle model (outbreaks between empty weeks) from there on;
    over-dispersed series above 50 a week are Gaussian on the log scale; the
    rest go by dispersion.
    """
    stats = df.groupBy(*keys).agg(
        F.avg(y).alias("mean_level"),
        ratio(F.var_samp(y), F.avg(y)).alias("dispersion"),
        F.avg((F.col(y) == 0).cast("int")).alias("zero_share"),
    )
    family = (
        F.when((F.col("zero_share") > 0.2) & (F.col("mean_level") >= 10), "hurdle_negative_binomial")
        .when(F.col("zero_share") > 0.2, "zero_inflated")
        .when((F.col("mean_level") > 50) & (F.col("dispersion") > 1), "log_gaussian")
        .when(F.col("dispersion") > 1.5, "negative_binomial")
        .otherwise("poisson")
    )
    return stats.withColumn("family", family)


def seasonal_profile(df: DataFrame, keys: list[str], week: str, y: str) -> DataFrame:
    """Mean per key and week of the year."""
    return df.groupBy(*keys, F.weekofyear(week).alias("week_of_year")).agg(F.avg(y).alias("profile"))


def seasonal_outliers(df: DataFrame, keys: list[str], week: str, y: str, width: float = 3.0) -> DataFrame:
    """Rows whose residual from the seasonal mean is larger than ``width`` IQRs of the residuals."""
    keyed = df.withColumn("week_of_year", F.weekofyear(week))
    resid = keyed.join(seasonal_profile(df, keys, week, y), [*keys, "week_of_year"]).withColumn(
        "residual", F.col(y) - F.col("profile")
    )
    cuts = quantiles(
        value_counts(resid, keys, "residual"), keys, "residual", {"q1": constant_level(0.25), "q3": constant_level(0.75)}
    ).drop("n")
    outside = F.abs("residual") > (F.col("q3") - F.col("q1")) * width
    return resid.join(cuts, keys).filter(outside)


def rolling_origin_errors(df: DataFrame, keys: list[str], order: str, y: str, start: int, horizons: int = 4, season: int = 52) -> DataFrame:
    """MAE and RMSE by horizon of naive and seasonal-naive forecasts from every
    origin past ``start`` rows. A forecast h ahead of origin t needs only y[t]
    and y[t + h - season], so all origins are scored by shifts, without refits."""
    w = ordered(keys, order)
    origins = df.withColumn("_t", F.row_number().over(w))
    cases = F.array(
        *[
            F.struct(
                F.lit(h).alias("h"), F.lead(y, h).over(w).alias("y"), F.col(y).alias("naive"),
                F.lag(y, season - h).over(w).alias("snaive"),
            )
            for h in range(1, horizons + 1)
        ]
    )
    scored = origins.withColumn("_f", cases).filter(F.col("_t") >= start).select(*keys, F.inline("_f")).filter(
        "y is not null and snaive is not null"
    )
    aggs = []
    for m in ("naive", "snaive"):
        e = F.col("y") - F.col(m)
        aggs += [F.avg(F.abs(e)).alias(f"mae_{m}"), F.sqrt(F.avg(e * e)).alias(f"rmse_{m}")]
    return scored.groupBy(*keys, "h").agg(F.count("*").alias("n"), *aggs)


def weighted_ensemble(df: DataFrame, keys: list[str], models: dict[str, float | None], errors: DataFrame | None = None) -> DataFrame:
    """Mean of model columns with equal weights, or weights 1 / error per key.

    ``errors`` has one ``<model>_err`` column per model.
    """
    names = list(models)
    if errors is None:
        total = sum((F.col(m) for m in names[1:]), F.col(names[0]))
        return df.withColumn("ensemble", total / len(names))
    joined = df.join(errors, keys)
    weights = {m: F.try_divide(F.lit(1.0), F.col(f"{m}_err")) for m in names}
    top = sum((weights[m] * F.col(m) for m in names[1:]), weights[names[0]] * F.col(names[0]))
    bottom = sum((weights[m] for m in names[1:]), weights[names[0]])
    return joined.withColumn("ensemble", F.try_divide(top, bottom))
