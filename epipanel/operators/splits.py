"""Temporal splits, expanding folds and exact-share random splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def year_conditions(test_year: int, week: str = "epi_sunday", open_end: bool = False) -> tuple[Column, Column]:
    """(before the year, in it) as conditions."""
    start, stop = F.lit(f"{test_year}-01-01").cast("date"), F.lit(f"{test_year + 1}-01-01").cast("date")
    test = F.col(week) >= start
    return F.col(week) < start, test if open_end else test & (F.col(week) < stop)


def year_split(df: DataFrame, test_year: int, week: str = "epi_sunday", open_end: bool = False):
    """(train, test): train ends before the year, test is the year itself."""
    before, inside = year_conditions(test_year, week, open_end)
    return df.filter(before), df.filter(inside)


def date_index(df: DataFrame, week: str = "epi_sunday") -> DataFrame:
    """Distinct weeks with position (0-based) and their number; calendar-sized."""
    weeks = df.select(week).distinct()
    w = Window.partitionBy(F.lit(0)).orderBy(week)
    return weeks.select(
        week,
        (F.row_number().over(w) - 1).alias("idx"),
        F.count("*").over(Window.partitionBy(F.lit(0))).alias("n_weeks"),
    )


def expanding_folds(df: DataFrame, week: str = "epi_sunday", n_splits: int = 5, gap: int = 4) -> DataFrame:
    """Week -> (fold, role) membership of expanding windows with a gap.

    With n weeks and t = n div (splits + 1), fold i validates on
    [n - (splits - i + 1) t, +t) and trains on all weeks before its start
    minus the gap. Each week is expanded to its folds in place.
    """
    n, i, fold = F.col("n_weeks"), F.col("idx"), F.col("fold")
    size = F.floor(n / (n_splits + 1))
    start = n - (n_splits + 1 - fold) * size
    role = F.when((i >= start) & (i < start + size), "validation").when(i < start - gap, "train")
    folds = F.explode(F.sequence(F.lit(1), F.lit(n_splits))).alias("fold")
    return (
        date_index(df, week)
        .select(week, "idx", "n_weeks", folds)
        .withColumn("role", role)
        .filter(F.col("role").isNotNull())
        .select(week, "fold", "role")
    )


def fold_bounds(df: DataFrame, week: str = "epi_sunday", n_splits: int = 5, gap: int = 4) -> DataFrame:
    """(fold, role, first week, last week, weeks): one row per side of a fold."""
    return expanding_folds(df, week, n_splits, gap).groupBy("fold", "role").agg(
        F.min(week).alias("first_week"), F.max(week).alias("last_week"), F.count("*").alias("n_weeks")
    )


def last_weeks(df: DataFrame, count: int, week: str = "epi_sunday") -> DataFrame:
    """Rows of the last ``count`` distinct weeks (semi join on the week list)."""
    recent = df.select(week).distinct().orderBy(F.desc(week)).limit(count)
    return df.join(recent, week, "left_semi")


def stratified_split(df: DataFrame, key: str, stratum: str, share: float = 0.8, seed: int = 42, order: Column | None = None):
    """(train, rest) with ``share`` of each stratum in train, exact to one row.

    Rows are ordered by a seeded hash of the key, or by ``order``, a hexadecimal digest. Hash slots are counted first;
    only the single slot where a stratum's quota ends is ordered row by row, so
    a large stratum is never sorted in one task. The quota's last row then cuts
    the input by comparison.
    """
    slots = 64 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = F.xxhash64(F.col(key), F.lit(seed)) if order is None else order
    slot = F.pmod("_h", F.lit(slots)) if order is None else F.conv(F.substring("_h", 1, 3), 16, 10).cast("long")
    hashed = df.withColumn("_h", by).withColumn("_slot", F.coalesce(slot, F.lit(0)))
    # a null stratum is a stratum: it joins by an empty list of values
    hashed = hashed.withColumn("_stratum", F.array_compact(F.array(stratum)))
    stratum = "_stratum"
    sizes = hashed.groupBy(stratum, "_slot").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(stratum).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    quota = F.floor(F.sum("_n").over(Window.partitionBy(stratum)) * share + 0.5)
    room = sizes.withColumn("_room", quota - F.coalesce(F.sum("_n").over(before), F.lit(0)))
    last = room.filter("_room > 0").groupBy(stratum).agg(
        F.max("_slot").alias("_cut_slot"), F.max_by(F.least("_room", "_n"), "_slot").alias("_need")
    )
    last = last.withColumn("_slot", F.col("_cut_slot"))
    edge = hashed.join(last, [stratum, "_slot"]).select(stratum, "_cut_slot", "_need", F.struct("_h", key).alias("_at"))
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy("_at"))
    cut = edge.withColumn("_r", rank).filter(F.col("_r") == F.col("_need")).select(stratum, "_cut_slot", "_at")
    placed = hashed.join(cut, stratum, "left")
    inside = (F.col("_slot") < F.col("_cut_slot")) | (
        (F.col("_slot") == F.col("_cut_slot")) & (F.struct("_h", key) <= F.col("_at"))
    )
    inside = F.coalesce(inside, F.lit(False))
    return placed.filter(inside).select(*df.columns), placed.filter(~inside).select(*df.columns)
