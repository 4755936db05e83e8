"""Horizon-specific conformal bands."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from epipanel.operators.ranks import constant_level, quantiles, value_counts
from epipanel.session import reliable_checkpoint, require_columns

MIN_SCORES = 30


def adaptive_epsilon(df: DataFrame, epsilon_min: float) -> float:
    """max(floor, 10th percentile of the predictions): one number on the driver."""
    p10 = quantiles(value_counts(df, [], "prediction"), [], "prediction", {"p10": constant_level(0.10)})
    return max(epsilon_min, p10.select("p10").first()[0])


def conformal_level(alpha: float):
    """min(1, ceil((n + 1)(1 - alpha)) / n)."""
    return lambda n: F.least(F.lit(1.0), F.ceil((n + 1) * F.lit(1.0 - alpha)) / n)


def nonconformity(epsilon: float) -> Column:
    return F.abs(F.col("cases") - F.col("prediction")) / (F.col("prediction") + F.lit(epsilon))


def pool_horizons(counts: DataFrame, horizon: str = "horizon", min_scores: int = MIN_SCORES) -> DataFrame:
    """Scores each horizon may use: its own, and those of all later horizons too
    when it has fewer than ``min_scores``.

    ``counts`` holds distinct (horizon, score) with ``n``. The short horizons are
    found first (one array, at most as long as the forecast), and a score is
    offered to its own horizon and the short ones before it.
    """
    sizes = counts.groupBy(horizon).agg(F.sum("n").alias("_size"))
    short = sizes.agg(F.sort_array(F.collect_list(F.when(F.col("_size") < min_scores, F.col(horizon).cast("int"))))).scalar()
    own = F.col(horizon).cast("int")
    placed = counts.select(own.alias("_own"), "score", "n", short.alias("_short"))
    offers = F.explode(F.concat(F.array("_own"), F.filter("_short", lambda h: h < F.col("_own"))))
    return placed.select(offers.alias(horizon), "score", "n").groupBy(horizon, "score").agg(F.sum("n").alias("n"))


def calibrate(
    df: DataFrame, alpha: float = 0.10, epsilon_min: float = 0.10, horizon: str = "horizon",
    min_scores: int = MIN_SCORES,
) -> DataFrame:
    """(horizon, n, level, q, epsilon, alpha): one row per calibrated horizon.

    The calibration rows feed several passes, so they are written once to the
    shared checkpoint folder instead of being derived again for each.
    """
    require_columns(df, "cases", "prediction", horizon)
    clean = df.select("cases", "prediction", F.col(horizon).cast("int").alias(horizon)).dropna()
    clean = reliable_checkpoint(clean)
    if clean.isEmpty():
        raise ValueError("no complete calibration rows")
    epsilon = adaptive_epsilon(clean, epsilon_min)
    scored = clean.select(horizon, nonconformity(epsilon).alias("score"))
    pooled = pool_horizons(value_counts(scored, [horizon], "score"), horizon, min_scores)
    level = conformal_level(alpha)
    cuts = quantiles(reliable_checkpoint(pooled), [horizon], "score", {"q": level})
    table = cuts.select(
        horizon,
        "n",
        level(F.col("n").cast("double")).alias("level"),
        "q",
        F.lit(epsilon).alias("epsilon"),
        F.lit(alpha).alias("alpha"),
    )
    return reliable_checkpoint(table)


def apply_bands(df: DataFrame, calibration: DataFrame, horizon: str = "horizon") -> DataFrame:
    """Add ``lower_ci`` / ``upper_ci``; unknown horizons use the largest known one."""
    require_columns(df, "prediction", horizon)
    table = calibration.select(F.col(horizon), F.col("q").alias("_q"))
    last_q = calibration.agg(F.max_by("q", horizon)).scalar()
    epsilon = calibration.agg(F.max("epsilon")).scalar()
    margin = F.coalesce("_q", last_q) * (F.col("prediction") + epsilon)
    return (
        df.join(table, horizon, "left")
        .withColumns(
            {
                "lower_ci": F.greatest(F.col("prediction") - margin, F.lit(0.0)),
                "upper_ci": F.col("prediction") + margin,
            }
        )
        .drop("_q")
    )


def bands_or_null(df: DataFrame, calibration_rows: DataFrame, alpha: float = 0.10, horizon: str = "horizon") -> DataFrame:
    """Calibrate and apply; an empty calibration set gives null bands, no failure."""
    try:
        table = calibrate(calibration_rows, alpha, horizon=horizon)
    except ValueError:
        blank = F.lit(None).cast("double")
        return df.withColumns({"lower_ci": blank, "upper_ci": blank})
    return apply_bands(df, table, horizon)


def save_calibration(calibration: DataFrame, path: str) -> None:
    """One JSON object per calibration, horizons as a map."""
    doc = calibration.groupBy("alpha", "epsilon").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("horizon").cast("string").alias("k"), "q"))).alias("quantiles"),
        F.struct(F.sum("n").alias("n_scores"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("made_at")).alias("metadata"),
    )
    doc.coalesce(1).write.mode("overwrite").json(path)


def load_calibration(spark: SparkSession, path: str) -> DataFrame | None:
    """Calibration rows back from JSON; ``None`` if nothing was saved there."""
    schema = "alpha double, epsilon double, quantiles map<string,double>, metadata struct<n_scores:long,made_at:string>"
    try:
        doc = spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    rows = doc.select("alpha", "epsilon", F.explode("quantiles").alias("horizon", "q"))
    return rows.withColumn("horizon", F.col("horizon").cast("int"))


OCTAVE = 32


def _bucket(score: Column) -> Column:
    """Place of a score on a fixed scale of ``OCTAVE`` steps for each doubling; it never falls as scores rise."""
    return F.when(score <= 0, F.lit(-(2**31))).otherwise(F.floor(F.log2(score) * OCTAVE)).cast("long")


def rolling_calibration(df: DataFrame, weeks_back: int, alpha: float = 0.10, epsilon: float = 0.10, week: str = "epi_sunday") -> DataFrame:
    """Quantile recomputed each week from the ``weeks_back`` weeks before it.

    Scores are counted per week and bucket of a fixed scale. A bucket's count goes up the week after and down
    when it leaves the window, so running sums give every week's bucket sizes whatever the window's width.
    They tell which one or two buckets hold the quantile's ranks; only the scores in those are looked at.
    """
    scored = df.dropna(subset=["cases", "prediction"]).select(week, nonconformity(epsilon).alias("score"))
    counts = reliable_checkpoint(value_counts(scored, [week], "score").withColumn("_b", _bucket(F.col("score"))))
    weeks = df.select(week).distinct()
    sizes = counts.groupBy(week, "_b").agg(F.sum("n").alias("n"))
    marks = sizes.select(
        "_b", F.inline(F.array(F.struct(F.date_add(week, 7).alias(week), F.col("n").alias("d")), F.struct(F.date_add(week, 7 * (weeks_back + 1)).alias(week), (-F.col("n")).alias("d"))))
    ).groupBy("_b", week).agg(F.sum("d").alias("d"))
    buckets = sizes.select("_b").distinct()
    grid = weeks.withColumn("_b", F.explode(buckets.agg(F.collect_list("_b")).scalar()))  # calendar x scale
    along = Window.partitionBy("_b").orderBy(week).rowsBetween(Window.unboundedPreceding, 0)
    held = (
        grid.withColumn("d", F.lit(0.0)).unionByName(marks.select(week, "_b", "d")).groupBy(week, "_b").agg(F.sum("d").alias("d"))
        .withColumn("n", F.sum("d").over(along)).join(weeks, week, "left_semi").where("n > 0")
    )
    held = reliable_checkpoint(held.select(week, "_b", "n"))
    below = Window.partitionBy(week).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("n").over(Window.partitionBy(week))
    placed = held.withColumns({"_total": total, "_below": F.coalesce(F.sum("n").over(below), F.lit(0.0))})
    level = conformal_level(alpha)
    position = (F.col("_total") - 1) * level(F.col("_total"))
    ranks = F.array(F.floor(position) + 1, F.ceil(position) + 1)
    wanted = placed.withColumn("_ranks", F.array_distinct(F.filter(ranks, lambda r: (r > F.col("_below")) & (r <= F.col("_below") + F.col("n"))))).where(F.size("_ranks") > 0)
    wanted = wanted.select(F.col(week).alias("_week"), F.col("_b").alias("_wb"), "_below", "_total", F.transform("_ranks", lambda r: r.cast("double")).alias("_ranks"))
    inside = (F.col("_b") == F.col("_wb")) & F.col(week).between(F.date_sub("_week", 7 * weeks_back), F.date_sub("_week", 7))
    near = counts.join(wanted, inside).groupBy("_week", "_wb", "_below", "_total", "_ranks", "score").agg(F.sum("n").alias("n"))
    upto = F.col("_below") + F.sum("n").over(Window.partitionBy("_week", "_wb").orderBy("score"))
    found = near.withColumn("_upto", upto).withColumn("_rank", F.explode("_ranks")).where((F.col("_upto") - F.col("n") < F.col("_rank")) & (F.col("_rank") <= F.col("_upto")))
    picked = found.groupBy(F.col("_week").alias(week)).agg(
        F.max("_total").alias("_total"), F.min_by("score", "_rank").alias("_lo"), F.max_by("score", "_rank").alias("_hi")
    )
    share = position - F.floor(position)
    return picked.select(week, F.col("_total").cast("long").alias("n"), (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * share).alias("q"))
