"""Sequential Bayesian filters, one weekly series per group, as folds over one array a series.

A series is collected after weekly aggregation, so an array is as long as the calendar however many source
records stand behind it; the recursions are built-in expressions and run inside the JVM. Every filter knows
only the weeks up to its own: prior moments and variances are parameters, nothing is taken from the whole
series. A null observation leaves the week's prior as it is.
"""

from __future__ import annotations

from math import cos, pi, sin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epipanel.functions.arrays import bound, scan
from epipanel.functions.scalars import digamma, trigamma

STATES = 5


def _paths(df: DataFrame, *values: str) -> DataFrame:
    """(unique_id, path): a series in order of ds; equal dates by their values."""
    return df.groupBy("unique_id").agg(F.sort_array(F.collect_list(F.struct("ds", *values))).alias("path"))


def _rows(paths: DataFrame, states: Column, values: tuple[str, ...], columns: dict[str, str]) -> DataFrame:
    """One row a week again: the path's columns and chosen fields of its state."""
    zipped = paths.select("unique_id", F.explode(F.arrays_zip(F.col("path").alias("p"), states.alias("s"))).alias("w"))
    return zipped.select(
        "unique_id", *(F.col(f"w.p.{c}").alias(c) for c in ("ds", *values)), *(F.col(f"w.s.{c}").alias(name) for c, name in columns.items())
    )


def _after_start(states: Column) -> Column:
    return F.slice(states, 2, F.size(states))


def local_level(df: DataFrame, m0: float = 0.0, c0: float = 1.0, v: float = 0.25, w: float = 0.04) -> DataFrame:
    """Local level with observation variance ``v`` and evolution variance ``w``: forecast, filtered and smoothed moments.

    Columns: forecast, forecast_var, level, level_var, smoothed, smoothed_var.
    """

    def step(last: Column, row: Column) -> Column:
        def updated(p: Column) -> Column:
            gain = p["r"] / (p["r"] + v)
            return F.struct(
                p["a"].alias("a"), p["r"].alias("r"), (p["r"] + v).alias("q"),
                F.when(row["y"].isNull(), p["a"]).otherwise(p["a"] + gain * (row["y"] - p["a"])).alias("m"),
                F.when(row["y"].isNull(), p["r"]).otherwise(p["r"] - gain * gain * (p["r"] + v)).alias("c"),
            )

        return bound(F.struct(last["m"].alias("a"), (last["c"] + w).alias("r")), updated)

    def smoothed(later: Column, state: Column) -> Column:
        gain = state["c"] / later["r"]
        return F.struct(
            state["a"].alias("a"),
            state["r"].alias("r"),
            (state["m"] + gain * (later["sm"] - later["a"])).alias("sm"),
            (state["c"] + gain * gain * (later["sv"] - later["r"])).alias("sv"),
        )

    zero = F.struct(*(F.lit(float(x)).alias(n) for n, x in (("a", m0), ("r", c0), ("q", c0 + v), ("m", m0), ("c", c0))))
    ahead = _paths(df, "y").withColumn("ahead", _after_start(scan(F.col("path"), zero, step)))
    last = F.element_at("ahead", -1)
    end = F.struct(last["a"].alias("a"), last["r"].alias("r"), last["m"].alias("sm"), last["c"].alias("sv"))
    back = F.reverse(scan(F.reverse(F.slice("ahead", 1, F.size("ahead") - 1)), end, smoothed))
    both = F.transform(
        F.arrays_zip(F.col("ahead").alias("f"), back.alias("b")),
        lambda z: F.struct(z["f"]["a"].alias("a"), z["f"]["q"].alias("q"), z["f"]["m"].alias("m"), z["f"]["c"].alias("c"), z["b"]["sm"].alias("sm"), z["b"]["sv"].alias("sv")),
    )
    names = {"a": "forecast", "q": "forecast_var", "m": "level", "c": "level_var", "sm": "smoothed", "sv": "smoothed_var"}
    return _rows(ahead, both, ("y",), names)


def evolution(period: float) -> list[list[float]]:
    """Evolution matrix of level, slope, one harmonic of ``period`` weeks and a driver's effect."""
    w = 2 * pi / period
    return [
        [1.0, 1.0, 0.0, 0.0, 0.0],
        [0.0, 1.0, 0.0, 0.0, 0.0],
        [0.0, 0.0, cos(w), sin(w), 0.0],
        [0.0, 0.0, -sin(w), cos(w), 0.0],
        [0.0, 0.0, 0.0, 0.0, 1.0],
    ]


def trend_season_climate(
    df: DataFrame,
    driver: str,
    m0: tuple[float, ...] = (0.0,) * STATES,
    c0: float = 1.0,
    v: float = 0.25,
    discounts: tuple[float, float, float] = (0.95, 0.995, 0.98),
    period: float = 52.0,
) -> DataFrame:
    """Level, slope, one seasonal harmonic and a driver's effect, with a discount factor for each block.

    ``discounts`` are those of the trend, season and driver blocks; covariances between blocks carry none.
    A week without a value of the driver has no driver effect. ``c0`` is the prior variance of each state.
    Columns: forecast, forecast_var, level, slope, season, effect.
    """
    g = evolution(period)
    block = (0, 0, 1, 1, 2)

    def discounted(i: int, j: int, c: Column) -> Column:
        terms = [F.get(c, STATES * k + m) * (g[i][k] * g[j][m]) for k in range(STATES) for m in range(STATES) if g[i][k] * g[j][m]]
        total = sum(terms[1:], terms[0])
        return total / discounts[block[i]] if block[i] == block[j] else total

    def step(last: Column, row: Column) -> Column:
        x = F.coalesce(row[driver], F.lit(0.0))
        prior = F.struct(
            F.array(*(sum((F.get(last["m"], k) * g[i][k] for k in range(STATES) if g[i][k]), F.lit(0.0)) for i in range(STATES))).alias("a"),
            F.array(*(discounted(i, j, last["c"]) for i in range(STATES) for j in range(STATES))).alias("r"),
        )

        def forecast(p: Column) -> Column:
            onto = F.array(*(F.get(p["r"], STATES * i) + F.get(p["r"], STATES * i + 2) + x * F.get(p["r"], STATES * i + 4) for i in range(STATES)))
            return bound(onto, lambda o: updated(p, o))

        def updated(p: Column, o: Column) -> Column:
            f = F.get(p["a"], 0) + F.get(p["a"], 2) + x * F.get(p["a"], 4)
            q = F.get(o, 0) + F.get(o, 2) + x * F.get(o, 4) + v
            return bound(F.struct(f.alias("f"), q.alias("q")), lambda z: posterior(p, o, z))

        def posterior(p: Column, o: Column, z: Column) -> Column:
            seen = row["y"].isNotNull()
            m = F.transform(p["a"], lambda a, i: F.when(seen, a + F.get(o, i) / z["q"] * (row["y"] - z["f"])).otherwise(a))
            c = F.transform(
                p["r"],
                lambda r, at: F.when(seen, r - F.get(o, F.floor(at / STATES).cast("int")) * F.get(o, at % STATES) / z["q"]).otherwise(r),
            )
            return F.struct(m.alias("m"), c.alias("c"), z["f"].alias("f"), z["q"].alias("q"))

        return bound(prior, forecast)

    zero = F.struct(
        F.array(*(F.lit(float(x)) for x in m0)).alias("m"),
        F.array(*(F.lit(float(c0) if i == j else 0.0) for i in range(STATES) for j in range(STATES))).alias("c"),
        F.lit(0.0).alias("f"), F.lit(0.0).alias("q"),
    )
    ahead = _paths(df, "y", driver).withColumn("ahead", _after_start(scan(F.col("path"), zero, step)))
    out = _rows(ahead, F.col("ahead"), ("y", driver), {"f": "forecast", "q": "forecast_var", "m": "m"})
    states = {name: F.get("m", k) for k, name in ((0, "level"), (1, "slope"), (2, "season"), (4, "effect"))}
    return out.withColumns(states).drop("m")


def poisson_filter(df: DataFrame, m0: float = 0.0, c0: float = 1.0, discount: float = 0.98) -> DataFrame:
    """Poisson counts with a log rate that drifts: gamma moments there and back through digamma and trigamma.

    Columns: expected (rate before the week), log_rate, log_rate_var, rate, low and high (95 % limits of the rate).
    """

    def step(last: Column, row: Column) -> Column:
        def updated(p: Column) -> Column:
            mean = F.exp(p["a"] + p["r"] / 2.0)
            var = F.exp(2.0 * p["a"] + p["r"]) * (F.exp(p["r"]) - 1.0)
            scale = mean / (var + 1e-9)
            return bound(F.struct(mean.alias("mean"), scale.alias("b"), (mean * scale).alias("a")), lambda z: seen(p, z))

        def seen(p: Column, z: Column) -> Column:
            shape, rate = z["a"] + row["y"], z["b"] + 1.0
            known = row["y"].isNotNull()
            return F.struct(
                z["mean"].alias("e"),
                F.when(known, digamma(shape) - F.log(rate)).otherwise(p["a"]).alias("m"),
                F.when(known, trigamma(shape)).otherwise(p["r"]).alias("c"),
                F.when(known, shape / rate).otherwise(z["mean"]).alias("rate"),
            )

        return bound(F.struct(last["m"].alias("a"), (last["c"] / discount).alias("r")), updated)

    zero = F.struct(F.lit(0.0).alias("e"), F.lit(float(m0)).alias("m"), F.lit(float(c0)).alias("c"), F.lit(0.0).alias("rate"))
    ahead = _paths(df, "y").withColumn("ahead", _after_start(scan(F.col("path"), zero, step)))
    out = _rows(ahead, F.col("ahead"), ("y",), {"e": "expected", "m": "log_rate", "c": "log_rate_var", "rate": "rate"})
    spread = 1.96 * F.sqrt("log_rate_var")
    return out.withColumns({"low": F.exp(F.col("log_rate") - spread), "high": F.exp(F.col("log_rate") + spread)})


def density(y: Column, mean: Column, var: Column) -> Column:
    return F.exp(-(y - mean) * (y - mean) / (2.0 * var)) / F.sqrt(2.0 * pi * var)


def alarm_monitor(df: DataFrame, threshold: float = 0.05, sensitivity: float = 2.0, reset: float = 1.5) -> DataFrame:
    """Bayes-factor alarms on given one-step forecasts (columns unique_id, ds, y, forecast, forecast_var).

    A week's factor is the density of the routine forecast over that of one with ``sensitivity`` times its
    variance. The product of factors raises an alarm below ``threshold`` and starts anew there and above ``reset``.
    A week without an observation leaves it. Columns: residual, factor, cumulative (after a new start), alarm.
    """

    def step(last: Column, row: Column) -> Column:
        alternative = density(row["y"], row["forecast"], row["forecast_var"] * sensitivity)
        factor = F.coalesce(density(row["y"], row["forecast"], row["forecast_var"]) / (alternative + 1e-12), F.lit(1.0))

        def judged(z: Column) -> Column:
            over = (z["l"] < threshold) | (z["l"] > reset)
            return F.struct(z["h"].alias("h"), F.when(over, 1.0).otherwise(z["l"]).alias("l"), (z["l"] < threshold).alias("alarm"))

        return bound(factor, lambda h: bound(F.struct(h.alias("h"), (last["l"] * h).alias("l")), judged))

    zero = F.struct(F.lit(1.0).alias("h"), F.lit(1.0).alias("l"), F.lit(False).alias("alarm"))
    ahead = _paths(df, "y", "forecast", "forecast_var").withColumn("ahead", _after_start(scan(F.col("path"), zero, step)))
    out = _rows(ahead, F.col("ahead"), ("y", "forecast", "forecast_var"), {"h": "factor", "l": "cumulative", "alarm": "alarm"})
    return out.withColumn("residual", (F.col("y") - F.col("forecast")) / F.sqrt("forecast_var"))
