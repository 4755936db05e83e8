"""Agreement of weekly counts between sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epipanel.functions.calendar import week_start
from epipanel.functions.scalars import abs_pct_diff


def weekly_source(rows: DataFrame, date_col: str, name: str) -> DataFrame:
    """Rows per week as column ``name``; unreadable dates drop out."""
    weekly = rows.groupBy(week_start(date_col).alias("epi_sunday")).agg(F.count("*").cast("double").alias(name))
    return weekly.filter(F.col("epi_sunday").isNotNull())


def align_sources(*sources: DataFrame) -> DataFrame:
    """Full outer join on the week, zero where a source has no row."""
    joined = reduce(lambda l, r: l.join(r, "epi_sunday", "full_outer"), sources)
    return joined.na.fill(0.0)


def source_differences(aligned: DataFrame, local: str, others: list[str]) -> DataFrame:
    cols = {}
    for o in others:
        cols[f"diff_{o}"] = F.col(local) - F.col(o)
        cols[f"diff_pct_{o}"] = abs_pct_diff(F.col(local), F.col(o))
    return aligned.withColumns(cols)


def source_agreement(aligned: DataFrame, local: str, others: list[str], min_corr: float = 0.90, max_mean_pct: float = 15.0) -> DataFrame:
    """Pearson r, mean and maximum absolute % difference and the accept flag,
    for all other sources in one aggregate."""
    long = aligned.unpivot(["epi_sunday", local], others, "source", "_v")
    pct = abs_pct_diff(F.col(local), F.col("_v"))
    stats = long.groupBy("source").agg(
        F.corr("_v", local).alias("corr"), F.avg(pct).alias("mean_pct"), F.max(pct).alias("max_pct")
    )
    accepted = (F.col("corr") >= min_corr) & (F.col("mean_pct") <= max_mean_pct)
    return stats.withColumn("accepted", F.coalesce(accepted, F.lit(False)))
