"""Per-series forecasts: one aggregate over many series, then folds over one array a series.

A series is weekly, so an array holds a calendar's worth of values however many source records stand behind
it. The recursions are built-in expressions and run inside the JVM. Weeks without a value are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epipanel.functions.arrays import bound, scan

SEASON = 52
ALPHAS = (0.1, 0.3, 0.5, 0.7, 0.9)
BETAS = (0.05, 0.2)
WINTERS = ((0.2, 0.05, 0.1), (0.2, 0.05, 0.3), (0.5, 0.05, 0.1), (0.5, 0.05, 0.3))


def seasonal_naive(train: DataFrame, horizon: int, season: int = SEASON, keys=("unique_id",)) -> DataFrame:
    """Last season shifted forward, as a window and an explode (no UDF)."""
    from pyspark.sql import Window

    back = Window.partitionBy(*keys).orderBy(F.desc("ds"))
    last = train.withColumn("_r", F.row_number().over(back)).filter(F.col("_r") <= season)
    cycles = -(-horizon // season)
    shifted = last.select(
        *keys, "_r", F.col("y").alias("seasonal_naive"), "ds", F.explode(F.sequence(F.lit(0), F.lit(cycles - 1))).alias("_c")
    ).withColumn("h", F.lit(season) - F.col("_r") + 1 + F.col("_c") * season)
    return shifted.filter(F.col("h") <= horizon).select(
        *keys, F.date_add("ds", (F.col("_c") + 1) * (7 * season)).alias("ds"), F.col("h").cast("int").alias("h"), "seasonal_naive"
    )


def drift(train: DataFrame, horizon: int, keys=("unique_id",)) -> DataFrame:
    """Line through the first and last point, from one aggregate per series."""
    ends = train.groupBy(*keys).agg(
        F.min_by("y", "ds").alias("_y1"), F.max_by("y", "ds").alias("_yn"), F.max("ds").alias("_d"), F.count("*").alias("_n")
    )
    h = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h")
    slope = F.coalesce(F.try_divide(F.col("_yn") - F.col("_y1"), (F.col("_n") - 1).cast("double")), F.lit(0.0))
    return ends.select(*keys, "_d", "_yn", slope.alias("_s"), h).select(
        *keys, F.date_add("_d", F.col("h") * 7).alias("ds"), "h", (F.col("_yn") + F.col("_s") * F.col("h")).alias("drift")
    )


def _paths(train: DataFrame) -> DataFrame:
    """(unique_id, path, v): dates with values in order, and the values alone."""
    path = F.sort_array(F.collect_list(F.struct("ds", F.col("y").cast("double").alias("y"))))
    placed = train.filter(F.col("y").isNotNull()).groupBy("unique_id").agg(path.alias("path"))
    return placed.withColumn("v", F.transform("path", lambda p: p["y"]))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _errors(v: Column, fits: Column) -> Column:
    """Sum of squared one-step errors."""
    return _total(F.zip_with(v, fits, lambda y, f: (y - f) * (y - f)))


def _least(tries: list[Callable[[int], Column]]) -> Column:
    """The try (a struct of error, place and more) of the least error, the first of equal ones."""
    return F.array_min(F.array(*(t(k) for k, t in enumerate(tries))))


def _best_ses(v: Column) -> Column:
    """(e, k, s): error, grid place, and one-step fits with the forecast level at the end."""

    def tried(alpha: float) -> Callable[[int], Column]:
        states = scan(v, F.get(v, 0), lambda fit, y: alpha * y + (1 - alpha) * fit)
        return lambda k: bound(states, lambda s: F.struct(_errors(v, F.slice(s, F.lit(1), F.size(v))).alias("e"), F.lit(k).alias("k"), s.alias("s")))

    return _least([tried(alpha) for alpha in ALPHAS])


def _best_holt(v: Column) -> Column:
    """(e, k, s): error, grid place, and states of level, slope and one-step fit."""

    def tried(alpha: float, beta: float) -> Callable[[int], Column]:
        def step(last: Column, y: Column) -> Column:
            fit = last["l"] + last["b"]
            return bound(
                F.struct(fit.alias("f"), (alpha * y + (1 - alpha) * fit).alias("l")),
                lambda n: F.struct(n["l"].alias("l"), (beta * (n["l"] - last["l"]) + (1 - beta) * last["b"]).alias("b"), n["f"].alias("f")),
            )

        start = F.struct(F.get(v, 0).alias("l"), F.coalesce(F.get(v, 1) - F.get(v, 0), F.lit(0.0)).alias("b"), F.get(v, 0).alias("f"))
        states = scan(F.slice(v, F.lit(2), F.size(v) - 1), start, step)
        return lambda k: bound(states, lambda s: F.struct(_errors(v, F.transform(s, lambda x: x["f"])).alias("e"), F.lit(k).alias("k"), s.alias("s")))

    return _least([tried(alpha, beta) for alpha, beta in product(ALPHAS, BETAS)])


def _line(v: Column) -> Column:
    """(level, slope) of the least-squares line over places 0, 1, ..."""
    n = F.size(v).cast("double")
    middle = (n - 1) / 2
    mean = _total(v) / n
    spread = _total(F.transform(v, lambda _, k: (k - middle) * (k - middle)))
    slope = F.coalesce(F.try_divide(_total(F.transform(v, lambda y, k: (k - middle) * y)), spread), F.lit(0.0))
    return bound(slope, lambda b: F.struct((mean - b * middle).alias("level"), b.alias("slope")))


def smoothing_forecasts(train: DataFrame, horizon: int) -> DataFrame:
    """SES, Holt and Theta per series: in-sample fits (h <= 0) and forecasts.

    Parameters are the best of a small grid by one-step errors. Theta is the mean of a linear trend and
    exponential smoothing of the doubled line.
    """
    fitted = _paths(train).select("unique_id", "path", "v", _line(F.col("v")).alias("line"))
    along = lambda k: F.col("line")["level"] + F.col("line")["slope"] * k
    doubled = F.transform("v", lambda y, k: 2.0 * y - along(k))
    fitted = fitted.withColumn("z", doubled).select(
        "unique_id", "path", "line", _best_ses(F.col("v"))["s"].alias("ses"), _best_holt(F.col("v"))["s"].alias("holt"), _best_ses(F.col("z"))["s"].alias("theta")
    )
    n = F.size("path")
    inside = F.transform(
        "path",
        lambda p, k: F.struct(
            p["ds"].alias("ds"), (k + 1 - n).alias("h"), F.get("ses", k).alias("ses"), F.get("holt", k)["f"].alias("holt"),
            ((along(k) + F.get("theta", k)) / 2).alias("theta"),
        ),
    )
    last = F.element_at("holt", -1)
    ahead = F.transform(
        F.sequence(F.lit(1), F.lit(horizon)),
        lambda h: F.struct(
            F.date_add(F.element_at("path", -1)["ds"], 7 * h).alias("ds"), h.alias("h"), F.element_at("ses", -1).alias("ses"),
            (last["l"] + last["b"] * h).alias("holt"), ((along(n + h - 1) + F.element_at("theta", -1)) / 2).alias("theta"),
        ),
    )
    return fitted.select("unique_id", F.inline(F.concat(inside, ahead)))


def _winters(v: Column, season: int, phi: float, alpha: float, beta: float, gamma: float) -> Column:
    """Last state: error, level, slope and the season, whose first entry is the next week's."""
    first = F.slice(v, 1, season)

    def step(last: Column, y: Column) -> Column:
        s, carried = F.get(last["s"], 0), last["l"] + phi * last["b"]
        return bound(
            F.struct(s.alias("s"), carried.alias("c"), (alpha * (y - s) + (1 - alpha) * carried).alias("l")),
            lambda n: F.struct(
                (last["e"] + (y - n["c"] - n["s"]) * (y - n["c"] - n["s"])).alias("e"),
                n["l"].alias("l"),
                (beta * (n["l"] - last["l"]) + (1 - beta) * phi * last["b"]).alias("b"),
                F.concat(F.slice(last["s"], 2, season - 1), F.array(gamma * (y - n["l"]) + (1 - gamma) * n["s"])).alias("s"),
            ),
        )

    def start(level: Column) -> Column:
        cycle = F.concat(F.transform(first, lambda y: y - level), F.array_repeat(F.lit(0.0), F.greatest(season - F.size(v), F.lit(0))))
        return F.aggregate(v, F.struct(F.lit(0.0).alias("e"), level.alias("l"), F.lit(0.0).alias("b"), cycle.alias("s")), step)

    return bound(_total(first) / F.size(first).cast("double"), start)


def holt_winters(train: DataFrame, horizon: int, season: int = SEASON, phi: float = 0.95) -> DataFrame:
    """Additive damped Holt-Winters on the log1p scale, the best of a small parameter grid by one-step errors."""
    paths = _paths(train).withColumn("v", F.transform("v", lambda y: F.log1p(y)))

    def tried(p: tuple[float, float, float]) -> Callable[[int], Column]:
        state = _winters(F.col("v"), season, phi, *p)
        return lambda k: bound(state, lambda s: F.struct(s["e"].alias("e"), F.lit(k).alias("k"), s["l"].alias("l"), s["b"].alias("b"), s["s"].alias("s")))

    best = paths.select("unique_id", F.element_at("path", -1)["ds"].alias("last"), _least([tried(p) for p in WINTERS]).alias("w"))
    damp = [sum(phi**k for k in range(1, h + 1)) for h in range(1, horizon + 1)]
    w = F.col("w")
    rows = best.select(
        "unique_id", "last", "w", F.explode(F.transform(F.lit(damp), lambda d, k: F.struct((k + 1).alias("h"), d.alias("d")))).alias("a")
    )
    raw = w["l"] + w["b"] * F.col("a.d") + F.get(w["s"], (F.col("a.h") - 1) % season)
    return rows.select(
        "unique_id", F.date_add("last", 7 * F.col("a.h")).alias("ds"), F.col("a.h").alias("h"), F.greatest(F.expm1(raw), F.lit(0.0)).alias("holt_winters")
    )
