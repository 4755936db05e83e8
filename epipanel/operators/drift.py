"""Distribution drift, coverage monitors and alert levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epipanel.functions.scalars import ratio
from epipanel.operators.metrics import coverage
from epipanel.operators.ranks import constant_level, quantiles, value_counts
from epipanel.operators.splits import last_weeks
from epipanel.session import reliable_checkpoint

BINS = 10
TINY = 1e-8


def stability_index(df: DataFrame, features: list[str], is_current: Column, alert: float = 0.2) -> DataFrame:
    """Population stability index per feature over decile bins of the reference.

    Values outside the reference range fall in no bin; the last bin is closed;
    shares divide by the full sample sizes. Values are counted first, so the
    edges and the bin sums work on distinct values.
    """
    long = df.select(is_current.alias("_cur"), *[F.col(f).cast("double").alias(f) for f in features]).unpivot(
        ["_cur"], features, "feature", "value"
    )
    sides = value_counts(long, ["feature"], "value", cur=F.col("_cur").cast("int"), ref=(~F.col("_cur")).cast("int"))
    sides = reliable_checkpoint(sides)
    reference = sides.filter("ref > 0").select("feature", "value", F.col("ref").alias("n"))
    levels = {f"e{i}": constant_level(i / BINS) for i in range(BINS + 1)}
    edges = quantiles(reference, ["feature"], "value", levels).select("feature", F.array(*levels).alias("edges"))
    totals = sides.groupBy("feature").agg(F.sum("cur").alias("_nc"), F.sum("ref").alias("_nr"))
    v, e = F.col("value"), F.col("edges")
    below = F.size(F.filter(e, lambda x: x <= v))
    bin_no = F.when(v == e[BINS], BINS).when((below >= 1) & (below <= BINS), below)
    binned = sides.join(edges, "feature").withColumn("bin", bin_no).filter("bin is not null")
    counted = binned.groupBy("feature", "bin").agg(F.sum("cur").alias("c"), F.sum("ref").alias("r"))
    slots = totals.select("feature", "_nc", "_nr", F.explode(F.sequence(F.lit(1), F.lit(BINS))).alias("bin"))
    full = slots.join(counted, ["feature", "bin"], "left").fillna(0.0, ["c", "r"])
    p = ratio(F.col("c"), F.col("_nc")) + TINY
    q = ratio(F.col("r"), F.col("_nr")) + TINY
    scored = full.groupBy("feature").agg(F.sum((p - q) * F.log(p / q)).alias("psi"))
    return scored.withColumn("alert", F.col("psi") > alert)


def recent_coverage(banded: DataFrame, weeks: int = 12, floor: float = 0.85) -> DataFrame:
    """Band coverage over the last ``weeks`` distinct weeks and its alert."""
    return last_weeks(banded, weeks).agg(coverage().alias("coverage")).withColumn("alert", F.col("coverage") < floor)


def alert_levels(series: DataFrame, history: DataFrame, keys: list[str], value: str = "cases") -> DataFrame:
    """0-3 by the 75th, 90th and 95th percentile of each key's history; a value on a cut has the higher level."""
    levels = {"p75": constant_level(0.75), "p90": constant_level(0.90), "p95": constant_level(0.95)}
    cuts = quantiles(value_counts(history, keys, value), keys, value, levels).drop("n")
    v = F.col(value)
    level = F.when(v >= F.col("p95"), 3).when(v >= F.col("p90"), 2).when(v >= F.col("p75"), 1).otherwise(0)
    return series.join(cuts, keys).withColumn("alert_level", level)


def delay_correction(df: DataFrame, keys: list[str], week: str, factors: dict[int, float], value: str = "cases") -> DataFrame:
    """Divide the last weeks by the share of records expected to have arrived.

    ``factors``: recency rank (1 = newest week) to completeness.
    """
    newest = F.max(week).over(Window.partitionBy(*keys))
    rank = (F.datediff(newest, week) / 7).cast("int") + 1
    table = F.create_map(*[x for k, f in factors.items() for x in (F.lit(k), F.lit(float(f)))])
    share = F.coalesce(F.try_element_at(table, rank), F.lit(1.0))
    return df.withColumn("completeness", share).withColumn("corrected", F.col(value) / F.col("completeness"))


def intervention_dummies(week: str, events: dict[str, tuple[str, str | None]]) -> dict[str, Column]:
    """0/1 columns: step (no end) or pulse (start, end) of dated interventions."""
    out = {}
    for name, (start, end) in events.items():
        on = F.col(week) >= F.lit(start).cast("date")
        if end:
            on = on & (F.col(week) <= F.lit(end).cast("date"))
        out[name] = on.cast("int")
    return out
