"""Stateful outbreak monitor over windowed counts."""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, log1p, pi, sqrt

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
COLUMNS = ["series", "at", "y", "forecast", "forecast_var", "residual", "factor", "cumulative", "alarm"]
OUT = "series string, at long, y double, forecast double, forecast_var double, residual double, factor double, cumulative double, alarm boolean"


def window_counts(events: DataFrame, key: str, every: str = "1 day", late: str = "24 hours") -> DataFrame:
    """Closed windows per series, the input of the monitor.

    Written to a table of its own, so the state function reads one row per
    series and window and never a raw event.
    """
    return (
        events.withWatermark("ts", late)
        .groupBy(F.window("ts", every).alias("w"), F.col(key).alias("series"))
        .agg(F.count("*").cast("double").alias("y"))
        .select("series", F.col("w.start").alias("day"), "y")
    )


def count_stream(spark: SparkSession, table: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema("series string, day timestamp, y double")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(table)


def density(y: float, mean: float, var: float) -> float:
    return exp(-((y - mean) ** 2) / (2 * var)) / sqrt(2 * pi * var)


class OutbreakMonitor(StatefulProcessor):
    """Local level of log counts and its Bayes-factor alarm for one series.

    Windows wait in a list state until the watermark has passed them, so they are judged in order of time
    whichever batch brought them; an event-time timer wakes the series then. A series without a window for
    ``idle_ms`` is forgotten.
    """

    def __init__(self, m0: float, c0: float, v: float, w: float, threshold: float, sensitivity: float, reset: float, idle_ms: int):
        self.m0, self.c0, self.v, self.w = m0, c0, v, w
        self.threshold, self.sensitivity, self.reset, self.idle_ms = threshold, sensitivity, reset, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.level = handle.getValueState("level", "m double, c double, cumulative double, last long")
        self.waiting = handle.getListState("waiting", "at long, y double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = self.level.get()[3] if self.level.exists() else None
        new = [(int(at), float(y)) for part in rows for at, y in zip(part["at"], part["y"]) if last is None or at > last]
        if new:
            self.waiting.appendList(new)
            for at in {at for at, _ in new}:
                self.handle.registerTimer(at)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        m, c, cumulative, last = self.level.get() if self.level.exists() else (self.m0, self.c0, 1.0, None)
        held = sorted(self.waiting.get()) if self.waiting.exists() else []
        due = [h for h in held if h[0] <= now]
        if not due:
            if not held and last is not None and now >= last + self.idle_ms:
                self.level.clear()
            return
        out = []
        for last, y in due:
            r = c + self.w
            q, seen = r + self.v, log1p(y)
            factor = density(seen, m, q) / (density(seen, m, q * self.sensitivity) + 1e-12)
            cumulative *= factor
            alarm = cumulative < self.threshold
            if alarm or cumulative > self.reset:
                cumulative = 1.0
            out.append((key[0], last, y, m, q, (seen - m) / sqrt(q), factor, cumulative, alarm))
            gain = r / q
            m, c = m + gain * (seen - m), r - gain * gain * q
        rest = [h for h in held if h[0] > now]
        self.waiting.put(rest) if rest else self.waiting.clear()
        self.level.update((m, c, cumulative, last))
        self.handle.registerTimer(last + self.idle_ms)
        yield pd.DataFrame(out, columns=COLUMNS)


def outbreak_monitor(
    counts: DataFrame,
    m0: float = 0.0,
    c0: float = 1.0,
    v: float = 0.25,
    w: float = 0.04,
    threshold: float = 0.05,
    sensitivity: float = 2.0,
    reset: float = 1.5,
    late: str = "0 seconds",
    idle_days: int = 365,
) -> DataFrame:
    """Alarms over a stream of window counts (series, day, y), on the log1p scale.

    The rule is that of ``filters.alarm_monitor`` on the forecasts of ``filters.local_level``. A window is
    judged once the watermark, ``late`` behind the newest window, has passed its day. Needs the RocksDB state
    store (``STORE``).
    """
    processor = OutbreakMonitor(m0, c0, v, w, threshold, sensitivity, reset, idle_days * 86_400_000)
    placed = counts.withWatermark("day", late).select("series", "day", F.unix_millis("day").alias("at"), "y")
    out = placed.groupBy("series").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=OUT, outputMode="Append", timeMode="EventTime"
    )
    return out.select("series", F.timestamp_millis("at").alias("day"), *COLUMNS[2:])
