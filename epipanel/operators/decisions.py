"""Comparison of feature configurations and the winner rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epipanel.operators.metrics import point_metrics, region_metrics, weekly_totals
from epipanel.operators.series import best_row

MIN_R2_GAIN = 0.05
MIN_IMPROVED_SHARE = 0.70
CONFIG = ("modelo", "config", "config_ord")


def accepted(delta, share):
    return F.coalesce((delta > MIN_R2_GAIN) | (share > MIN_IMPROVED_SHARE), F.lit(False))


def config_scores(predictions: DataFrame) -> DataFrame:
    """Point metrics of the weekly totals per (modelo, config, config_ord)."""
    return point_metrics(weekly_totals(predictions, *CONFIG), *CONFIG)


def aligned_regions(regional: DataFrame) -> DataFrame:
    """Each region's RMSE next to the one of the previous configuration."""
    cur = regional.select(*CONFIG, "ra", F.col("rmse_ra").alias("rmse_cur"))
    prev = regional.select(
        "modelo", (F.col("config_ord") + 1).alias("config_ord"), "ra", F.col("rmse_ra").alias("rmse_prev")
    )
    joined = cur.join(prev, ["modelo", "config_ord", "ra"])
    return joined.withColumn("improved", F.col("rmse_cur") < F.col("rmse_prev"))


def config_steps(predictions: DataFrame) -> DataFrame:
    """R2 gain and share of improved regions against the previous configuration."""
    steps = aligned_regions(region_metrics(predictions, *CONFIG))
    share = steps.groupBy(*CONFIG).agg(F.avg(F.col("improved").cast("int")).alias("improved_share"))
    order = Window.partitionBy("modelo").orderBy("config_ord")
    scored = config_scores(predictions).withColumn("delta_r2", F.col("r2") - F.lag("r2").over(order))
    joined = scored.join(share, list(CONFIG), "left")
    return joined.withColumn("accepted", accepted(F.col("delta_r2"), F.col("improved_share")))


def winner(predictions: DataFrame, baseline: str) -> DataFrame:
    """One row: the best observed configuration if it beats the best baseline by
    the acceptance rule, else that baseline. Ties go to the earlier config."""
    scored = config_scores(predictions).select(*CONFIG, "r2", "rmse")
    one = F.lit(1).alias("_one")
    tie = (-F.coalesce("r2", F.lit(-float("inf"))), F.col("config_ord"), F.col("modelo"))
    best = best_row(scored.select("*", one), ["_one"], *tie)
    base = best_row(scored.filter(F.col("config") == baseline).select("*", one), ["_one"], *tie)
    pair = best.select("_one", *[F.col(c).alias(f"best_{c}") for c in scored.columns]).join(
        base.select("_one", *[F.col(c).alias(f"base_{c}") for c in scored.columns]), "_one"
    )
    regional = region_metrics(predictions, *CONFIG)
    chosen = regional.join(
        pair.select(F.col("best_modelo").alias("modelo"), F.col("best_config").alias("config")), ["modelo", "config"], "left_semi"
    ).select("ra", F.col("rmse_ra").alias("_best"))
    against = regional.join(
        pair.select(F.col("base_modelo").alias("modelo"), F.col("base_config").alias("config")), ["modelo", "config"], "left_semi"
    ).select("ra", F.col("rmse_ra").alias("_base"))
    share = chosen.join(against, "ra").agg(
        F.coalesce(F.avg((F.col("_best") < F.col("_base")).cast("int")), F.lit(0.0)).alias("best_improved_share")
    ).select("*", one)
    judged = pair.join(share, "_one").withColumn("best_delta_r2", F.col("best_r2") - F.col("base_r2"))
    ok = accepted(F.col("best_delta_r2"), F.col("best_improved_share"))
    pick = {c: F.when(ok, F.col(f"best_{c}")).otherwise(F.col(f"base_{c}")) for c in ("config", "modelo", "r2", "rmse")}
    return judged.select(
        *[v.alias(k) for k, v in pick.items()], "best_config", "best_modelo", "best_delta_r2", "best_improved_share", ok.alias("accepted")
    )
