"""Region names: canonical keys, aliases, population and coverage reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.functions.text import norm_key

NOT_INFORMED = "NAO INFORMADO"

# Spellings that stand for another region key.
DEFAULT_ALIASES = {
    "SCIA (ESTRUTURAL)": "SCIA",
    "SOL NASCENTE/POR DO SOL": "SOL NASCENTE E POR DO SOL",
    "SOL NASCENTE/POR DO SOL RES": "SOL NASCENTE E POR DO SOL",
}


def alias_table(spark: SparkSession, aliases: dict[str, str]) -> DataFrame:
    """Driver-defined alias list as a two-column table of normalised keys."""
    raw = spark.createDataFrame(list(aliases.items()), "alias string, canon string")
    return raw.select(norm_key(F.col("alias")).alias("alias"), norm_key(F.col("canon")).alias("canon"))


def canonical_region(df: DataFrame, source: str, aliases: DataFrame, out: str = "ra") -> DataFrame:
    """Replace a raw region name by its key; 'not informed' and null give null.

    ``aliases`` comes from ``alias_table``, a list written in the code; Spark
    broadcasts it by its size.
    """
    keyed = df.withColumn("alias", norm_key(F.col(source)))
    joined = keyed.join(aliases, "alias", "left")
    key = F.coalesce("canon", "alias")
    named = F.when(F.col("alias") != NOT_INFORMED, key)
    return joined.withColumn(out, named).drop("alias", "canon")


def project_population(
    base: DataFrame,
    base_year: int,
    first_year: int,
    last_year: int,
    break_year: int = 2020,
    rate_before: float = 0.0139,
    rate_from: float = 0.0120,
) -> DataFrame:
    """(ra, populacao) of one year spread over a year range at two growth rates.

    Years from ``break_year`` on use ``rate_from``; earlier years leave the
    break-year level at ``rate_before``. Rounded half-even to whole people.
    """
    year = F.col("ano")
    to_break = F.pow(F.lit(1.0 + rate_from), F.greatest(year, F.lit(break_year)) - base_year)
    past_break = F.pow(F.lit(1.0 + rate_before), F.least(year - break_year, F.lit(0)))
    years = F.explode(F.sequence(F.lit(first_year), F.lit(last_year))).alias("ano")
    return base.select("ra", F.col("populacao").cast("double").alias("_base"), years).select(
        "ra", "ano", F.bround(F.col("_base") * to_break * past_break).cast("long").alias("populacao")
    )


def population_by_year(population: DataFrame) -> DataFrame:
    return population.groupBy("ano").agg(F.sum("populacao").alias("populacao"))


def lost_regions(cases: DataFrame, population: DataFrame) -> DataFrame:
    """Region keys with cases but no population row, with the rows at stake."""
    seen = cases.filter(F.col("ra").isNotNull()).groupBy("ra").agg(F.count("*").alias("rows_lost"))
    return seen.join(population.select("ra").distinct(), "ra", "left_anti")


def is_state(col, code: int = 53, name: str = "DF") -> Column:
    """True for a numeric code or a text code, whatever the column mixes."""
    number = F.expr(f"try_cast({col} as double)") == float(code)
    text = F.upper(F.trim(F.col(col).cast("string"))) == name
    return F.coalesce(number, F.lit(False)) | F.coalesce(text, F.lit(False))
