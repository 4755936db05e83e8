"""Per-series window operators. A series holds one row per week, so a window
partition is bounded by the calendar once counts are taken."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from epipanel.functions.scalars import ratio


def ordered(keys: Sequence[str], order: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def add_lags(df: DataFrame, keys, order: str, cols: Iterable[str], lags: Iterable[int]) -> DataFrame:
    """``<col>_lag_<n>`` columns; one window spec gives one shuffle and one sort."""
    w = ordered(keys, order)
    lags = list(lags)
    return df.withColumns({f"{c}_lag_{n}": F.lag(c, n).over(w) for c in cols for n in lags})


def add_trend(df: DataFrame, col: str = "cases") -> DataFrame:
    """Two deltas and a growth ratio from the first three lags."""
    l1, l2, l3 = (F.col(f"{col}_lag_{i}") for i in (1, 2, 3))
    return df.withColumns(
        {
            f"{col}_delta_1": l1 - l2,
            f"{col}_delta_2": l2 - l3,
            f"{col}_growth_rate": ratio(l1 + 1.0, l2 + 1.0),
        }
    )


def lead_target(df: DataFrame, keys, order: str, target: str, horizon: int, out: str) -> DataFrame:
    """Value ``horizon`` rows ahead; the last rows of a series, without one, go."""
    return df.withColumn(out, F.lead(target, horizon).over(ordered(keys, order))).filter(
        F.col(out).isNotNull()
    )


def position_horizon(df: DataFrame, keys, order: str, cap: int | None = 4, out: str = "horizon") -> DataFrame:
    """Position inside the series as the forecast horizon, capped unless ``cap`` is ``None``."""
    place = F.row_number().over(ordered(keys, order))
    return df.withColumn(out, place if cap is None else F.least(place, F.lit(cap)))


def differenced(df: DataFrame, keys, order: str, col: str, step: int) -> DataFrame:
    return df.withColumn(f"{col}_diff_{step}", F.col(col) - F.lag(col, step).over(ordered(keys, order)))


def pct_change(df: DataFrame, keys, order: str, col: str) -> DataFrame:
    before = F.lag(col).over(ordered(keys, order))
    return df.withColumn(f"{col}_pct_change", (ratio(F.col(col), before) - 1.0) * 100.0)


def holdout_tail(df: DataFrame, keys, order: str, rows: int) -> tuple[DataFrame, DataFrame]:
    """(train, test): the last ``rows`` rows per series are the test part."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    ranked = df.withColumn("_from_end", F.row_number().over(w))
    train = ranked.filter(F.col("_from_end") > rows).drop("_from_end")
    test = ranked.filter(F.col("_from_end") <= rows).drop("_from_end")
    return train, test


def best_row(df: DataFrame, keys, *order: Column) -> DataFrame:
    """One row per key under a total order, by ``min`` of an ordering struct.

    An aggregate, not a window: partial minima are taken map-side, so a hot key
    never meets in one sort. ``order`` columns sort ascending; negate to
    reverse. Null order values sort first, as in Spark.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*keys, "_row.*")


def interpolate(
    df: DataFrame, keys, order: str, col: str, back_limit: int = 4, mode: str = "linear"
) -> DataFrame:
    """Fill gaps: linear by row position, last value at the end, a bounded
    back-fill at the start. ``mode='ffill'`` never looks at a later value
    inside a gap."""
    base = Window.partitionBy(*keys).orderBy(order)
    past = base.rowsBetween(Window.unboundedPreceding, 0)
    future = base.rowsBetween(0, Window.unboundedFollowing)
    known = F.col(col).isNotNull()
    numbered = df.withColumn("_i", F.row_number().over(base))
    ends = numbered.withColumns(
        {
            "_v0": F.last(col, ignorenulls=True).over(past),
            "_i0": F.last(F.when(known, F.col("_i")), ignorenulls=True).over(past),
            "_v1": F.first(col, ignorenulls=True).over(future),
            "_i1": F.first(F.when(known, F.col("_i")), ignorenulls=True).over(future),
        }
    )
    v0, v1, i0, i1, i = (F.col(c) for c in ("_v0", "_v1", "_i0", "_i1", "_i"))
    inside = v0 + (v1 - v0) * ratio(i - i0, i1 - i0)
    if mode == "ffill":
        inside = v0
    filled = (
        F.when(known, F.col(col))
        .when(i0.isNotNull() & i1.isNotNull(), inside)
        .when(i0.isNotNull(), v0)
        .when(i1 - i <= back_limit, v1)
    )
    return ends.withColumn(col, filled).drop("_i", "_v0", "_i0", "_v1", "_i1")


def coverage_gaps(df: DataFrame, cols: Sequence[str], order: str = "epi_sunday", first: int = 5) -> DataFrame:
    """Missing weeks per column: count and the first few, in one aggregate."""
    stacked = df.select(
        order, F.explode(F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]))).alias("column_name")
    )
    weeks = stacked.groupBy("column_name", order).agg(F.count("*").alias("_n"))
    ranked = weeks.withColumn("_r", F.row_number().over(Window.partitionBy("column_name").orderBy(order)))
    return ranked.groupBy("column_name").agg(
        F.sum("_n").alias("missing"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("_r") <= first, F.col(order)))), ",").alias("first_weeks"),
    )


def require_coverage(df: DataFrame, cols: Sequence[str], order: str = "epi_sunday") -> DataFrame:
    """Raise when a required column still has nulls, naming the first weeks."""
    gaps = coverage_gaps(df, cols, order).collect()
    if gaps:
        raise ValueError("; ".join(f"{g[0]}: {g[1]} missing, first {g[2]}" for g in gaps))
    return df


def runs_of(df: DataFrame, keys, order: str, condition: Column, at_least: int = 3) -> DataFrame:
    """Flag rows inside a run of at least ``at_least`` consecutive weeks that
    meet a condition (gaps and islands on the week number)."""
    held = df.withColumn("_held", F.coalesce(condition, F.lit(False)))
    week = F.datediff(order, F.lit("1970-01-04")) / 7
    island = F.when(
        F.col("_held"), week - F.row_number().over(Window.partitionBy(*keys, "_held").orderBy(order))
    )
    marked = held.withColumn("_island", island)
    size = F.count("*").over(Window.partitionBy(*keys, "_held", "_island"))
    return marked.withColumn("in_run", F.col("_held") & (size >= at_least)).drop("_held", "_island")
