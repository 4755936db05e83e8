"""Descriptive tables: counts, nulls, labels, text means."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epipanel.functions import text
from epipanel.functions.scalars import null_nan, ratio
from epipanel.operators.ranks import constant_level, quantiles, value_counts
from epipanel.operators.targets import CaseDefinition


def value_counts_desc(df: DataFrame, col: str) -> DataFrame:
    """Counts per value, null as its own group, largest first."""
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col)


def top_pairs(df: DataFrame, a: str, b: str, k: int) -> DataFrame:
    full = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    return full.groupBy(a, b).agg(F.count("*").alias("n")).orderBy(F.desc("n"), a, b).limit(k)


def code_counts(df: DataFrame, code: str) -> DataFrame:
    """Counts per numeric code shown as text, null as ``NA``."""
    shown = F.coalesce(F.col(code).cast("string"), F.lit("NA")).alias("code")
    return df.groupBy(shown).agg(F.count("*").alias("n")).orderBy("code")


def definition_counts(df: DataFrame, definition: CaseDefinition, *keys: str) -> DataFrame:
    """Rows per case definition and rows with any class, per key or overall."""
    return df.groupBy(*keys).agg(
        *[F.count_if(m).alias(name) for name, m in definition.masks().items()],
        F.count(definition.class_col).alias("classified"),
    )


def peak_rows(df: DataFrame, keys: list[str], week: str, value: str) -> DataFrame:
    """First week with the highest value per key, by aggregate (no sort)."""
    first = F.struct(F.col(value), -F.datediff(week, F.lit("1970-01-01")))
    return df.groupBy(*keys).agg(F.max_by(week, first).alias("peak_week"), F.max(value).alias(f"peak_{value}"))


def pivot_lags(correlations: DataFrame, value: str, lags) -> DataFrame:
    """Variable x lag table from ``<variable>_lag_<n>`` rows."""
    parts = correlations.select(
        F.regexp_replace("feature", "_lag_[0-9]+$", "").alias("variable"),
        F.regexp_extract("feature", "_lag_([0-9]+)$", 1).cast("int").alias("_lag"),
        value,
    )
    wide = parts.groupBy("variable").pivot("_lag", list(lags)).agg(F.first(value))
    return wide.select("variable", *[F.col(f"`{n}`").alias(f"lag_{n}") for n in lags])


def label_correlations(df: DataFrame, labels: list[str], strong: float) -> DataFrame:
    """Pearson r of every label pair in one pass, flagged when strong."""
    pairs = list(combinations(labels, 2))
    one = df.agg(*[null_nan(F.corr(x, y)).alias(f"r{i}") for i, (x, y) in enumerate(pairs)])
    rows = [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"r{i}").alias("r")) for i, (x, y) in enumerate(pairs)]
    return one.select(F.inline(F.array(*rows))).withColumn("strong", F.coalesce(F.abs("r") > strong, F.lit(False)))


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Null count and percent per column, most nulls first; one scan."""
    one = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = one.unpivot(["_n"], cols, "column_name", "nulls")
    pct = ratio(F.col("nulls") * 100.0, F.col("_n"))
    return long.select("column_name", "nulls", pct.alias("null_pct")).orderBy(F.desc("nulls"), "column_name")


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, sd, min, quartiles, max per numeric column (exact quartiles)."""
    long = df.select(*cols).unpivot([], cols, "column_name", "_v")
    stats = long.groupBy("column_name").agg(
        F.count("_v").alias("n"), F.avg("_v").alias("mean"), F.stddev_samp("_v").alias("sd"),
        F.min("_v").alias("lowest"), F.max("_v").alias("highest"),
    )
    levels = {"p25": constant_level(0.25), "p50": constant_level(0.5), "p75": constant_level(0.75)}
    cuts = quantiles(value_counts(long, ["column_name"], "_v"), ["column_name"], "_v", levels).drop("n")
    return stats.join(cuts, "column_name")


def label_totals(df: DataFrame, labels: list[str]) -> DataFrame:
    one = df.agg(F.count("*").alias("_n"), *[F.sum(c).cast("long").alias(c) for c in labels])
    long = one.unpivot(["_n"], labels, "label", "total")
    return long.select("label", "total", ratio(F.col("total") * 100.0, F.col("_n")).alias("pct"))


def labels_per_row(df: DataFrame, labels: list[str]) -> DataFrame:
    count = sum((F.col(c) for c in labels[1:]), F.col(labels[0]))
    return df.groupBy(count.cast("int").alias("n_labels")).agg(F.count("*").alias("n"))


def text_means(df: DataFrame, col: str, by: str) -> DataFrame:
    """Mean length, words and share of each pattern per class."""
    t = F.col(col)
    return df.groupBy(by).agg(
        F.avg(F.length(t)).alias("chars"),
        F.avg(text.word_count(t)).alias("words"),
        (F.avg(text.has_capitals(t)) * 100.0).alias("caps_pct"),
        (F.avg(text.has_exclamations(t)) * 100.0).alias("exclaim_pct"),
        (F.avg(text.has_questions(t)) * 100.0).alias("question_pct"),
    )
