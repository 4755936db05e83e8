"""Dense week x region panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epipanel.functions.calendar import season_angles
from epipanel.functions.scalars import fill_zero, per_100k
from epipanel.operators.series import add_lags, add_trend
from epipanel.session import reliable_checkpoint

CLIMATE_COLS = ("precip_sum", "temp_mean", "umidmed")
CLIMATE_LAGS = range(2, 9)
CASE_LAGS = range(1, 5)


def weekly_counts(df: DataFrame, *keys: str, weight: str | None = None) -> DataFrame:
    """Cases per key; ``weight`` sums counts that were already taken upstream."""
    value = F.sum(weight) if weight else F.count("*")
    return df.groupBy(*keys).agg(value.cast("double").alias("cases"))


def week_region_grid(regions: DataFrame, first_week, last_week) -> DataFrame:
    """Every Sunday of the span for every region.

    The span is expanded inside each region row, so no cross join is planned.
    Bounds may be literals or scalar subqueries.
    """
    weeks = F.explode(F.sequence(first_week, last_week, F.expr("interval 7 days")))
    return regions.select("ra").distinct().select("ra", weeks.alias("epi_sunday"))


def dense_counts(counts: DataFrame, regions: DataFrame, first_week=None, as_of=None) -> DataFrame:
    """Grid with zero for weeks without cases.

    ``first_week`` / ``as_of`` default to the span of the counts, so the output
    does not depend on the day it is run. Reading the span from the counts would
    scan the source a second time, so in that case the counts (one row per week
    and region) are written first.
    """
    if first_week is None or as_of is None:
        counts = reliable_checkpoint(counts)
    first = counts.agg(F.min("epi_sunday")).scalar() if first_week is None else F.lit(first_week).cast("date")
    last = counts.agg(F.max("epi_sunday")).scalar() if as_of is None else F.lit(as_of).cast("date")
    grid = week_region_grid(regions, first, last)
    return grid.join(counts, ["epi_sunday", "ra"], "left").withColumn(
        "cases", fill_zero(F.col("cases"))
    )


def add_population(panel: DataFrame, population: DataFrame, by_year: bool = True) -> DataFrame:
    """Inner join on (ra, year): weeks outside the population years leave the panel.

    ``by_year=False`` takes one fixed population per region instead.
    """
    keys = ["ra", "ano"] if by_year else ["ra"]
    return (
        panel.withColumn("ano", F.year("epi_sunday"))
        .join(population.select(*keys, "populacao"), keys)
        .withColumn("incidencia_100k", per_100k(F.col("cases"), F.col("populacao")))
    )


def weeks_without_population(panel: DataFrame, population: DataFrame) -> DataFrame:
    """Quality report: (ra, year) pairs the inner join would drop."""
    keyed = panel.withColumn("ano", F.year("epi_sunday"))
    return keyed.join(population, ["ra", "ano"], "left_anti").groupBy("ra", "ano").agg(
        F.count("*").alias("weeks_dropped")
    )


def climate_lags(climate: DataFrame, station: str = "station_id", cols=CLIMATE_COLS) -> DataFrame:
    """Lags 2-8 taken on the station series, before it meets the regions."""
    return add_lags(climate, [station], "epi_sunday", cols, CLIMATE_LAGS)


def one_row_per_week(climate: DataFrame, *keys: str) -> DataFrame:
    """``climate`` as it is; the query fails where a week repeats within the keys."""
    repeats = F.count("*").over(Window.partitionBy(*keys, "epi_sunday"))
    message = F.concat(F.lit("several climate rows in the week of "), F.col("epi_sunday").cast("string"))
    checked = climate.withColumn("_repeats", repeats)
    once = F.when(F.col("_repeats") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return checked.filter(once).drop("_repeats")


def build_panel(
    counts: DataFrame, population: DataFrame, climate: DataFrame,
    by_year: bool = True, climate_join: str = "left", climate_cols=CLIMATE_COLS, stations: DataFrame | None = None, **span,
) -> DataFrame:
    """Counts + population + climate + lags + trend + season, one row per week and region.

    ``stations`` maps a region (``ra``) to its ``station_id``; without it the
    climate must have one station. A fixed population (``by_year=False``) and ``climate_join='inner'``, which
    keeps only weeks with climate rows, give the earlier form of the panel.
    """
    dense = dense_counts(counts, population, **span)
    rated = add_population(dense, population, by_year)
    lagged_climate = climate_lags(climate, cols=climate_cols)
    if stations is None:
        joined = rated.join(one_row_per_week(lagged_climate.drop("station_id")), "epi_sunday", climate_join)
    else:
        placed = rated.join(stations.select("ra", "station_id"), "ra", "left")
        joined = placed.join(one_row_per_week(lagged_climate, "station_id"), ["station_id", "epi_sunday"], climate_join).drop("station_id")
    lagged = add_lags(joined, ["ra"], "epi_sunday", ("cases", "incidencia_100k"), CASE_LAGS)
    day = F.col("epi_sunday")
    return (
        add_trend(lagged)
        .withColumns({"week_of_year": F.weekofyear(day), "month": F.month(day)})
        .withColumns(season_angles(day))
    )
