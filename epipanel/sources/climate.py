"""Weather and surveillance inputs of the climate series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.functions.calendar import parse_day, week_start
from epipanel.operators.series import best_row, interpolate, require_coverage

HUMIDITY = ("umidmed", "umidmin", "umidmax")
DAILY = "time array<string>, temperature_2m_max array<double>, temperature_2m_min array<double>, temperature_2m_mean array<double>, precipitation_sum array<double>"
PAYLOAD = f"daily struct<{DAILY.replace(' array', ':array')}>"


def daily_from_payload(payloads: DataFrame, json_col: str = "payload", *keep: str) -> DataFrame:
    """Parallel JSON arrays to one row per day."""
    daily = payloads.select(*keep, F.from_json(json_col, PAYLOAD)["daily"].alias("_p")).select(*keep, "_p.*")
    names = [c for c in daily.columns if c not in keep]
    rows = daily.select(*keep, F.inline(F.arrays_zip(*names)))
    return rows.select(
        *keep,
        parse_day("time").alias("date"),
        F.col("temperature_2m_max").alias("temp_max"),
        F.col("temperature_2m_min").alias("temp_min"),
        F.col("temperature_2m_mean").alias("temp_mean"),
        F.col("precipitation_sum").alias("precip_sum"),
    )


def read_payload(spark: SparkSession, path: str) -> DataFrame:
    """Weather service files, one JSON document each."""
    raw = spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")
    return daily_from_payload(raw)


def weekly_weather(daily: DataFrame, *keys: str) -> DataFrame:
    """Daily to weekly: three means and a sum."""
    return daily.groupBy(*keys, week_start("date").alias("epi_sunday")).agg(
        F.avg("temp_max").alias("temp_max"),
        F.avg("temp_min").alias("temp_min"),
        F.avg("temp_mean").alias("temp_mean"),
        F.sum("precip_sum").alias("precip_sum"),
    )


def read_weekly_weather(spark: SparkSession, path: str) -> DataFrame:
    schema = "epi_sunday string, temp_max double, temp_min double, temp_mean double, precip_sum double"
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False).withColumn("epi_sunday", parse_day("epi_sunday"))


def read_surveillance(spark: SparkSession, path: str) -> DataFrame:
    """Weekly humidity, one row per week.

    Files carry more columns than are used; ``select`` prunes the scan. Where a
    week repeats, the smallest row in column order wins, so the result does not
    depend on file order.
    """
    raw = spark.read.csv(path, header=True)
    picked = raw.select(
        parse_day("data_iniSE").alias("epi_sunday"),
        *[F.expr(f"try_cast({c} as double)").alias(c) for c in HUMIDITY],
    )
    return best_row(picked, ["epi_sunday"], *[F.col(c) for c in HUMIDITY])


def climate_series(weather: DataFrame, humidity: DataFrame, station: str = "S0") -> DataFrame:
    """Weather with humidity filled in, checked for missing required weeks."""
    joined = weather.join(humidity, "epi_sunday", "left").withColumn("station_id", F.lit(station))
    for c in HUMIDITY:
        joined = interpolate(joined, ["station_id"], "epi_sunday", c)
    return require_coverage(joined, ["temp_mean", "precip_sum"])
