"""Experiments: cross-validation, tuning, ablation, rolling and direct forecasts.

Boosted models of an experiment (folds, grid points, input sets, horizons) are grown in one batch, which
shares every pass over the panel. For the other models the driver loops over fits. The panel is written once
to the shared checkpoint folder.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epipanel.operators import boosting, conformal, decisions, learners
from epipanel.operators.metrics import consolidated, mae, r2, rmse
from epipanel.operators.recursion import recursive_forecast
from epipanel.operators.series import best_row, position_horizon
from epipanel.operators.splits import fold_bounds, last_weeks, year_conditions, year_split
from epipanel.plans.features import FEATURE_SETS, FeatureSet, feature_set
from epipanel.session import reliable_checkpoint


def _named(config: str | FeatureSet) -> FeatureSet:
    return feature_set(config) if isinstance(config, str) else config


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


@dataclass(frozen=True)
class Model:
    """A boosted model of a batch: the rows it trains on and those it predicts.

    ``target`` replaces the feature set's own where the value to learn stands in another column.
    """

    features: FeatureSet
    params: dict | None
    train: Column
    predict: Column
    target: str | None = None


def _complete(features: FeatureSet, *more: str) -> Column:
    needed = [*features.input_columns(), "epi_sunday", "ra", "cases", "populacao", features.target, *more]
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in dict.fromkeys(needed)])


def boosted_batch(panel: DataFrame, models: list[Model]) -> DataFrame:
    """Predictions of all models, numbered by ``job``: the panel's columns and ``prediction``.

    The models' inputs are put side by side, with a dummy for each region (as many as regions, collected); a
    model sees those of its own feature set. Models without a training row predict nothing.
    """
    names = list(dict.fromkeys(c for m in models for c in m.features.numeric_columns()))
    regions = sorted(r[0] for r in panel.select("ra").where(F.col("ra").isNotNull()).distinct().collect()) if any(m.features.region for m in models) else []
    inputs = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in names] + [F.coalesce(F.col("ra") == r, F.lit(False)).cast("double") for r in regions]
    rows = panel.withColumn("x", F.array(*inputs))
    jobs = []
    for m in models:
        places = [names.index(c) for c in m.features.numeric_columns()]
        if m.features.region:
            places += range(len(names), len(inputs))
        target = m.target or m.features.target
        jobs.append(boosting.Job(F.log1p(F.col(target)), m.train & _complete(m.features, target), learners.boosting(m.params), tuple(places)))
    forests = boosting.fit_many(rows, jobs)
    fitted = [k for k, f in enumerate(forests) if not (f.value != f.value).any()]
    wanted = F.array_compact(F.array(*(F.when(m.predict & _complete(m.features), F.lit(k)) for k, m in enumerate(models) if k in fitted)))
    asked = rows.withColumn("job", F.explode(wanted)) if fitted else rows.withColumn("job", F.lit(0)).where("false")
    raw = boosting.scores(asked, forests).drop("x")
    cases = reduce(lambda rest, k: F.when(F.col("job") == k, learners.to_cases(F.col("raw"), models[k].features)).otherwise(rest), fitted, F.lit(None).cast("double"))
    return raw.withColumn("prediction", cases).drop("raw")


def _fold_parts(train: DataFrame, n_splits: int, gap: int) -> list[tuple[Column, Column]]:
    """(train, validation) conditions of the folds that have both."""
    bounds = {(r.fold, r.role): r for r in fold_bounds(train, n_splits=n_splits, gap=gap).collect()}
    week = F.col("epi_sunday")
    parts = []
    for fold in range(1, n_splits + 1):
        both = [bounds.get((fold, role)) for role in ("train", "validation")]
        if all(both):
            parts.append(tuple(week.between(r.first_week, r.last_week) for r in both))
    return parts


def cv_score(train: DataFrame, features: FeatureSet, model: str, params: dict | None = None, n_splits: int = 5, gap: int = 4) -> float | None:
    """Mean validation RMSE in cases over expanding folds; empty folds skipped."""
    if model == "XGB":
        return boosted_cv(train, features, [params], n_splits, gap)[0]
    scores = []
    for parts in _fold_parts(train, n_splits, gap):
        rows = [features.complete_rows(train.filter(p)) for p in parts]
        if any(r.isEmpty() for r in rows):
            continue
        fitted = learners.fit(rows[0], features, model, params)
        scores.append(learners.predict(fitted, rows[1], features).agg(rmse()).first()[0])
    return sum(scores) / len(scores) if scores else None


def boosted_cv(train: DataFrame, features: FeatureSet, grid: list[dict | None], n_splits: int = 5, gap: int = 4) -> list[float | None]:
    """``cv_score`` of every grid point, all folds of all points in one batch."""
    folds = _fold_parts(train, n_splits, gap)
    if not folds:
        return [None] * len(grid)
    models = [Model(features, params, *parts) for params in grid for parts in folds]
    point = F.floor(F.col("job") / len(folds)).cast("int")
    by_fold = boosted_batch(train, models).groupBy(point.alias("point"), "job").agg(rmse().alias("rmse"))
    got = {r.point: r.score for r in by_fold.groupBy("point").agg(F.avg("rmse").alias("score")).collect()}
    return [got.get(k) for k in range(len(grid))]


def tune(
    panel: DataFrame, config: str | FeatureSet, grids: dict[str, dict[str, list]], test_year: int, n_splits: int = 5
) -> tuple[DataFrame, DataFrame]:
    """Grid search per model, then refit of the best parameters.

    Returns (tuning table ordered by model and score, test-year predictions).
    """
    features = _named(config)
    panel = reliable_checkpoint(panel)
    train, _ = year_split(panel, test_year)
    rows = []
    for model, grid in grids.items():
        points = [dict(zip(grid, values)) for values in product(*grid.values())]
        scores = boosted_cv(train, features, points, n_splits) if model == "XGB" else [cv_score(train, features, model, p, n_splits) for p in points]
        rows += [(model, features.name, score, json.dumps(p, sort_keys=True)) for p, score in zip(points, scores, strict=True)]
    spark = panel.sparkSession
    tuning = spark.createDataFrame(rows, "modelo string, config string, cv_rmse double, params string")
    best = {r.modelo: json.loads(r.params) for r in best_row(tuning, ["modelo"], F.coalesce("cv_rmse", F.lit(float("inf"))), F.col("params")).collect()}
    finals = [
        learners.fit_and_predict(panel, features, m, p, test_year).predictions.withColumns(
            {"modelo": F.lit(f"{m}_tuned"), "config": F.lit(features.name)}
        )
        for m, p in sorted(best.items())
    ]
    return tuning.orderBy("modelo", F.asc_nulls_last("cv_rmse"), "params"), _union(finals)


def ablation(panel: DataFrame, test_year: int, models: dict[str, dict | None], configs: list[str | FeatureSet] | None = None) -> dict[str, DataFrame]:
    """Every configuration with every model: predictions, steps and winner."""
    sets = [_named(c) for c in configs or FEATURE_SETS]
    panel = reliable_checkpoint(panel)
    parts = []
    for model, params in models.items():
        if model == "XGB":
            before, inside = year_conditions(test_year)
            batch = boosted_batch(panel, [Model(f, params, before, inside) for f in sets])
            named = F.element_at(F.array(*(F.lit(f.name) for f in sets)), F.col("job") + 1)
            parts.append(batch.select(*learners.PREDICTION_COLS, named.alias("config"), F.lit(model).alias("modelo"), F.col("job").alias("config_ord")))
            continue
        for i, features in enumerate(sets):
            result = learners.fit_and_predict(panel, features, model, params, test_year)
            parts.append(result.predictions.withColumns({"config": F.lit(features.name), "modelo": F.lit(model), "config_ord": F.lit(i)}))
    predictions = reliable_checkpoint(_union(parts))
    sizes = F.create_map(*[x for f in sets for x in (F.lit(f.name), F.lit(len(f.input_columns())))])
    return {
        "predictions": predictions,
        "summary": decisions.config_steps(predictions).withColumn("n_features", sizes[F.col("config")]),
        "winner": decisions.winner(predictions, baseline=sets[0].name),
    }


def rolling_validation(
    panel: DataFrame, test_year: int, config: str | FeatureSet = "lag+clima+RA", model: str = "RF", params: dict | None = None,
    calibration_weeks: int = 26, max_horizon: int = 4, alpha: float = 0.10,
) -> dict[str, DataFrame]:
    """One-step nowcast against the closed recursive forecast, both with bands.

    The last weeks before the test year are held out of the fit and calibrate
    the bands, so scores are out of sample; metrics are taken after banding.
    """
    features = _named(config)
    panel = reliable_checkpoint(panel)
    train, test = year_split(panel, test_year)
    held = last_weeks(train, calibration_weeks)
    cut = held.agg(F.min("epi_sunday")).first()[0]
    fitted = learners.fit(train.filter(F.col("epi_sunday") < F.lit(cut)), features, model, params)
    scored = learners.predict(fitted, held, features)
    calibration_rows = position_horizon(scored, ["ra"], "epi_sunday", max_horizon)
    now = learners.predict(fitted, test, features).select(*learners.PREDICTION_COLS).withColumn("horizon", F.lit(1))
    closed = position_horizon(recursive_forecast(panel, fitted, features, test_year), ["ra"], "epi_sunday", max_horizon)
    both = now.withColumn("modo", F.lit("nowcasting_rolling")).unionByName(
        closed.withColumn("modo", F.lit("forecast_fechado_recursivo"))
    )
    banded = reliable_checkpoint(conformal.bands_or_null(both, calibration_rows, alpha).drop("horizon"))
    return {"predictions": banded, "metrics": consolidated(banded, "modo", alpha=alpha)}


def direct_multihorizon(
    panel: DataFrame, config: str | FeatureSet, model: str, horizons: int, test_year: int, params: dict | None = None
) -> dict[str, object]:
    """One model per horizon k on the value k weeks ahead, scored on that value.

    Training rows whose target would fall inside the test year are left out. Boosted models of all horizons
    are one batch; ``models`` holds the fitted pipelines of other ones.
    """
    features = _named(config)
    panel = reliable_checkpoint(panel)
    ahead = Window.partitionBy("ra").orderBy("epi_sunday")
    wide = panel.withColumns(
        {f"_{c}_{k}": F.lead(c, k).over(ahead) for c in dict.fromkeys((features.target, "cases")) for k in range(1, horizons + 1)}
    )
    before, test = year_conditions(test_year)
    due = [F.date_add("epi_sunday", 7 * k) for k in range(horizons + 1)]
    known = [F.col("epi_sunday") < F.date_sub(F.lit(f"{test_year}-01-01").cast("date"), 7 * k) for k in range(horizons + 1)]
    columns = lambda scored, k: scored.select(
        "epi_sunday", due[k].alias("target_week"), "ra", F.col(f"_cases_{k}").alias("cases"), "populacao", "prediction", F.lit(k).alias("horizon")
    )
    fitted, parts = {}, []
    steps = range(1, horizons + 1)
    if model == "XGB":
        wide = reliable_checkpoint(wide)
        batch = boosted_batch(wide, [Model(features, params, known[k], test & F.col(f"_{features.target}_{k}").isNotNull(), f"_{features.target}_{k}") for k in steps])
        batch = reliable_checkpoint(batch)
        parts = [columns(batch.filter(F.col("job") == k - 1), k) for k in steps]
    else:
        for k in steps:
            rows = wide.filter(F.col(f"_{features.target}_{k}").isNotNull())
            shifted = rows.filter(known[k]).withColumn(features.target, F.col(f"_{features.target}_{k}"))
            fitted[k] = learners.fit(shifted, features, model, params)
            parts.append(columns(learners.predict(fitted[k], rows.filter(test), features), k))
    predictions = _union(parts)
    per_horizon = consolidated(predictions.withColumn("epi_sunday", F.col("target_week")), "horizon")
    return {"predictions": predictions, "metrics": per_horizon, "models": fitted}


def legacy_evaluation(panel: DataFrame, test_year: int, models: dict[str, dict | None], features: FeatureSet | None = None) -> DataFrame:
    """Region-week metrics of the full feature set over an open-ended test part."""
    panel = reliable_checkpoint(panel)
    features = features or feature_set("lag+clima+RA")
    parts = [
        learners.fit_and_predict(panel, features, m, p, test_year, open_end=True).predictions.withColumn("modelo", F.lit(m))
        for m, p in models.items()
    ]
    return _union(parts).groupBy("modelo").agg(
        r2().alias("r2"), mae().alias("mae"), rmse().alias("rmse"), F.count("*").alias("n_rows")
    )
