"""Streaming forms of the weekly counts and their joins.

Every function takes and returns a streaming (or batch) DataFrame; ``runner``
drives one to completion into a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
SUNDAY_OFFSET = "3 days"  # the epoch is a Thursday; windows start on Sundays
LATE = "24 hours"


def zoned(ntz: str) -> Column:
    """Wall-clock time read as UTC, whatever the session zone; watermarks and
    week offsets need a zoned timestamp."""
    since = f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {ntz})"
    return F.timestamp_micros(F.expr(since))


def wall_clock(zoned_ts: str) -> Column:
    """Inverse of ``zoned``."""
    return F.expr(f"timestampadd(MICROSECOND, unix_micros({zoned_ts}), timestamp_ntz'1970-01-01 00:00:00')")


def event_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """File stream over one Parquet file or a folder of them.

    A file stream takes a folder or a pattern; with its last character as a
    one-letter set the path is a pattern that matches itself only.
    """
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    exact = path.rstrip("/")
    return reader.parquet(f"{exact[:-1]}[{exact[-1]}]").withColumn("ts", zoned("ts"))


def weekly_counts(events: DataFrame, key: str, late: str | None = LATE) -> DataFrame:
    """Tumbling Sunday weeks; rows up to ``late`` behind still update their week."""
    timed = events.withWatermark("ts", late) if late else events
    return (
        timed.groupBy(F.window("ts", "7 days", "7 days", SUNDAY_OFFSET).alias("w"), key)
        .agg(F.count("*").alias("n"))
        .select(F.to_date(wall_clock("w.start")).alias("epi_sunday"), key, "n")
    )


def hopping_counts(events: DataFrame, key: str, size: str, slide: str, late: str = LATE) -> DataFrame:
    return (
        events.withWatermark("ts", late)
        .groupBy(F.window("ts", size, slide).alias("w"), key)
        .agg(F.count("*").alias("n"))
        .select(wall_clock("w.start").alias("window_start"), key, "n")
    )


def sessions(events: DataFrame, key: str, gap: str = "30 minutes", late: str = LATE) -> DataFrame:
    """Runs of activity separated by an inactivity gap."""
    return (
        events.withWatermark("ts", late)
        .groupBy(F.session_window("ts", gap).alias("w"), key)
        .agg(F.count("*").alias("n"))
        .select(wall_clock("w.start").alias("session_start"), wall_clock("w.end").alias("session_end"), key, "n")
    )


def enrich(events: DataFrame, dimension: DataFrame, key: str, row_id: str, salts: int = 8) -> DataFrame:
    """Stream-table join that spreads each key over ``salts`` slots.

    A streaming plan has no adaptive skew split, so a hot key is divided by the
    row id and the static side is repeated once per slot.
    """
    salted = events.withColumn("_salt", F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int"))
    copies = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [key, "_salt"]).drop("_salt")


def followed_within(first: DataFrame, second: DataFrame, key: str, hours: int = 1, late: str = LATE) -> DataFrame:
    """Pairs where ``second`` comes within ``hours`` after ``first`` for the key.

    The time slot is part of the join key, so one key's events spread over
    slots; a first event is offered to its own slot and the next, where every
    possible partner lies exactly once.
    """
    length = hours * 3600

    def slot(ts):
        return F.floor(F.unix_micros(ts) / (length * 1_000_000))

    a = first.withWatermark("ts", late).select(
        F.col("event_id").alias("first_id"), F.col(key), F.col("ts").alias("first_ts"),
        F.explode(F.array(slot(F.col("ts")), slot(F.col("ts")) + 1)).alias("_slot"),
    )
    b = second.withWatermark("ts", late).select(
        F.col("event_id").alias("second_id"), F.col(key).alias("_key"), F.col("ts").alias("second_ts"), slot(F.col("ts")).alias("_slot2")
    )
    inside = F.expr(f"second_ts >= first_ts and second_ts <= first_ts + interval {hours} hours")
    return a.join(b, (F.col(key) == F.col("_key")) & (F.col("_slot") == F.col("_slot2")) & inside).select(
        key, "first_id", "second_id", "first_ts", "second_ts"
    )


def once_only(events: DataFrame, row_id: str = "event_id", late: str = LATE) -> DataFrame:
    """Drop repeats of an at-least-once source within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([row_id])
