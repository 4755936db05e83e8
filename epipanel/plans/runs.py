"""End-to-end runs: from counts to the final metric tables, every result under a run id."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epipanel.operators import experiments, hierarchy, learners, metrics, perseries, series
from epipanel.plans.features import feature_set
from epipanel.session import reliable_checkpoint
from epipanel.sources import results


def hierarchy_run(leaves: DataFrame, levels: list[str], horizon: int, root: str, run_id: str) -> DataFrame:
    """Totals of every level, seasonal-naive forecasts of the last ``horizon`` weeks,
    bottom-up and top-down reconciliation, error by level; returns the stored errors."""
    tree = reliable_checkpoint(hierarchy.aggregate_levels(leaves, levels))
    train, test = series.holdout_tail(tree, ["unique_id"], "ds", horizon)
    ahead = perseries.seasonal_naive(train, horizon).withColumnRenamed("seasonal_naive", "yhat").drop("h")
    base = reliable_checkpoint(test.join(ahead, ["unique_id", "ds"]))
    depth = len(levels)
    out = base
    for name, reconciled in (("bottom_up", hierarchy.bottom_up(base, depth)), ("top_down", hierarchy.top_down(base, depth))):
        out = out.join(reconciled.select("unique_id", "ds", F.col("rec").alias(name)), ["unique_id", "ds"], "left")
    results.write_result(out.drop("ancestors"), root, "forecasts", run_id)
    results.write_result(metrics.level_mape(out, ["yhat", "bottom_up", "top_down"]), root, "level_errors", run_id)
    return results.read_result(leaves.sparkSession, root, "level_errors", run_id).drop("run_id")


def panel_run(
    panel: DataFrame, test_year: int, models: dict[str, dict | None], grids: dict[str, dict[str, list]], root: str, run_id: str,
    configs: list[str] | None = None,
) -> DataFrame:
    """Ablation, tuning of the winning configuration, rolling validation with its best
    parameters, and final metrics; returns the stored final table, one row per model."""
    panel = reliable_checkpoint(panel)
    ablation = experiments.ablation(panel, test_year, models, configs)
    winner = ablation["winner"].first()
    tuning, finals = experiments.tune(panel, winner.config, {winner.modelo: grids[winner.modelo]}, test_year)
    best = json.loads(series.best_row(tuning, ["modelo"], F.coalesce("cv_rmse", F.lit(float("inf"))), F.col("params")).first().params)
    rolling = experiments.rolling_validation(panel, test_year, winner.config, winner.modelo, best)
    fitted = learners.fit_and_predict(panel, feature_set(winner.config), winner.modelo, best, test_year)
    finals = finals.select(*learners.PREDICTION_COLS, "modelo").unionByName(
        fitted.predictions.withColumn("modelo", F.lit(winner.modelo))
    )
    for name, table in (
        ("ablation", ablation["summary"]), ("winner", ablation["winner"]), ("tuning", tuning),
        ("rolling", rolling["metrics"]), ("final", metrics.consolidated(finals, "modelo")),
    ):
        results.write_result(table, root, name, run_id)
    return results.read_result(panel.sparkSession, root, "final", run_id).drop("run_id")
