"""The roles of the weekly panel bound to star-schema tables.

orders play the case line list, nations the regions, line items the climate
series, customers the population.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from epipanel.functions.calendar import week_start
from epipanel.operators import panel, regions, series
from epipanel.operators.targets import CaseDefinition

DEFINITION = CaseDefinition(
    probable=("P", "F"),
    exact=("1-URGENT",),
    family=("1-URGENT", "2-HIGH", "3-MEDIUM"),
    class_col="o_orderstatus",
    disease_col="o_orderpriority",
)
BASE_YEAR, FIRST_YEAR, LAST_YEAR, BREAK_YEAR = 2000, 1995, 2003, 1998
TEST_YEAR = 2000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def customer_regions(spark: SparkSession, sf: str) -> DataFrame:
    """Customer -> region name."""
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("ra"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return customer.join(nation, "c_nationkey").select(F.col("c_custkey").alias("o_custkey"), "ra")


def counts_by(spark: SparkSession, sf: str, rows: DataFrame, *keys: str) -> DataFrame:
    """Order counts per region and further keys.

    Counted per customer before the join, so a customer holding a third of the
    orders enters the join with at most one row per week.
    """
    member = rows.groupBy("o_custkey", *keys).agg(F.count("*").alias("_n"))
    placed = member.join(customer_regions(spark, sf), "o_custkey")
    return panel.weekly_counts(placed, *keys, "ra", weight="_n")


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").withColumn("epi_sunday", week_start("o_orderdate"))


def case_counts(spark: SparkSession, sf: str, target: str = "probable") -> DataFrame:
    rows = orders(spark, sf).filter(DEFINITION.mask(target))
    return counts_by(spark, sf, rows, "epi_sunday")


def base_population(spark: SparkSession, sf: str) -> DataFrame:
    """Customers per nation; nations without customers keep a zero."""
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("ra"))
    heads = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("_n"))
    return nation.join(heads, nation.n_nationkey == heads.c_nationkey, "left").select(
        "ra", F.coalesce("_n", F.lit(0)).cast("long").alias("populacao")
    )


def population(spark: SparkSession, sf: str) -> DataFrame:
    return regions.project_population(
        base_population(spark, sf), BASE_YEAR, FIRST_YEAR, LAST_YEAR, BREAK_YEAR
    )


def weekly_climate(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly line-item averages with gaps put into one column by rule."""
    weekly = (
        table(spark, sf, "lineitem")
        .groupBy(week_start("l_shipdate").alias("epi_sunday"))
        .agg(
            F.avg("l_discount").alias("temp_mean"),
            F.sum("l_quantity").cast("double").alias("precip_sum"),
            F.avg("l_tax").alias("_humid"),
        )
        .withColumn("station_id", F.lit("S0"))
    )
    w = Window.partitionBy("station_id").orderBy("epi_sunday")
    n = F.count("*").over(Window.partitionBy("station_id"))
    numbered = weekly.withColumns({"_i": F.row_number().over(w), "_n": n})
    gap = (F.col("_i") % 5 == 0) | (F.col("_i") <= 6) | (F.col("_i") > F.col("_n") - 3)
    return numbered.withColumn("umidmed", F.when(~gap, F.col("_humid"))).select(
        "epi_sunday", "station_id", "temp_mean", "precip_sum", "umidmed"
    )


def climate(spark: SparkSession, sf: str) -> DataFrame:
    return series.interpolate(weekly_climate(spark, sf), ["station_id"], "epi_sunday", "umidmed")


def grid(spark: SparkSession, sf: str, target: str = "probable") -> DataFrame:
    return panel.dense_counts(case_counts(spark, sf, target), base_population(spark, sf))


def full_panel(spark: SparkSession, sf: str, target: str = "probable") -> DataFrame:
    return panel.build_panel(case_counts(spark, sf, target), population(spark, sf), climate(spark, sf))


def naive_predictions(spark: SparkSession, sf: str, lag: int) -> DataFrame:
    """Value ``lag`` weeks earlier as the prediction of the test year."""
    w = series.ordered(["ra"], "epi_sunday")
    ahead = grid(spark, sf).withColumn("prediction", F.lag("cases", lag).over(w))
    return ahead.filter((F.year("epi_sunday") == TEST_YEAR) & F.col("prediction").isNotNull())


def hierarchy_leaves(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly counts per nation with its region, the leaves of the tree."""
    nation = table(spark, sf, "nation").select(F.col("n_name").alias("ra"), "n_regionkey")
    region = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    return grid(spark, sf).join(nation.join(region, "n_regionkey"), "ra").select(
        F.lit("ALL").alias("top"), "region", F.col("ra").alias("nation"), F.col("epi_sunday").alias("ds"), F.col("cases").alias("y")
    )


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
