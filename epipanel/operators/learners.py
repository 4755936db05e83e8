"""Panel regressors as pipelines: encode, fit on log1p, predict back in cases."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epipanel.functions.scalars import null_nan, rate_to_count
from epipanel.operators.boosting import BoostedRegressor, Boosting
from epipanel.operators.metrics import consolidated, region_metrics
from epipanel.operators.splits import year_split
from epipanel.plans.features import FeatureSet

SEED = 42
MAX_DEPTH = 30  # Spark's upper limit, used where a model asks for no limit
RAW, LABEL, VECTOR, REGION = "_raw", "_label", "_features", "_region_vec"

DEFAULTS = {
    "RF": {"n_estimators": 150, "max_depth": 15, "max_features": "all"},
    "XGB": {"n_estimators": 200, "learning_rate": 0.05, "max_depth": 4},
    "LIN": {},
}
NAMES = {
    "RF": {"n_estimators": "numTrees", "max_depth": "maxDepth", "min_samples_leaf": "minInstancesPerNode", "max_features": "featureSubsetStrategy", "subsample": "subsamplingRate"},
    "XGB": {
        "n_estimators": "rounds", "max_depth": "depth", "learning_rate": "rate", "subsample": "rows", "colsample_bytree": "columns",
        "reg_lambda": "penalty", "min_child_weight": "least_weight", "gamma": "least_gain",
    },
    "LIN": {"ridge": "regParam"},
}


#: Memory of a task's node sums: more nodes of a forest share a pass over the rows.
FOREST_MEMORY_MB = 1024


def translated(name: str, params: dict | None) -> dict:
    """A model's parameters under the names of what fits it, defaults included."""
    if name not in DEFAULTS:
        raise ValueError(f"unknown model {name!r}; have {list(DEFAULTS)}")
    out = {}
    for key, value in {**DEFAULTS[name], **(params or {})}.items():
        if key not in NAMES[name]:
            raise ValueError(f"unknown parameter {key!r} for {name}")
        if key == "max_depth":
            if value is not None and int(value) > MAX_DEPTH:
                raise ValueError(f"max_depth {value} is beyond {MAX_DEPTH}; None means {MAX_DEPTH}")
            value = MAX_DEPTH if value is None else int(value)
        if NAMES[name][key] == "featureSubsetStrategy":
            value = str(value)
        out[NAMES[name][key]] = value
    return out


def boosting(params: dict | None) -> Boosting:
    return Boosting(**translated("XGB", params), seed=SEED)


def make_regressor(name: str, params: dict | None = None, label: str = LABEL):
    """'RF' is a random forest, 'XGB' second-order boosted trees, 'LIN' least squares."""
    own = translated(name, params)
    if name == "XGB":
        return BoostedRegressor(featuresCol=VECTOR, labelCol=label, predictionCol=RAW, settings=json.dumps(asdict(boosting(params))))
    if name == "LIN":
        return LinearRegression(featuresCol=VECTOR, labelCol=label, predictionCol=RAW, solver="normal", standardization=False, **own)
    return RandomForestRegressor(
        featuresCol=VECTOR, labelCol=label, predictionCol=RAW, seed=SEED, maxMemoryInMB=FOREST_MEMORY_MB, cacheNodeIds=True, **own
    )


def encoder_stages(features: FeatureSet, labels: list[str] | None = None) -> list:
    """One-hot region (unseen -> all zero), numeric columns passed through.

    With ``keep`` the unseen label is the last index and ``dropLast`` maps it to
    zeros. ``labels`` fixes the dummy columns instead of learning them.
    """
    stages = []
    if features.region:
        if labels is None:
            indexer = StringIndexer(inputCol="ra", outputCol="_region_idx", handleInvalid="keep")
        else:
            indexer = StringIndexerModel.from_labels(labels, "ra", "_region_idx", handleInvalid="keep")
        stages += [indexer, OneHotEncoder(inputCol="_region_idx", outputCol=REGION, dropLast=True)]
    inputs = features.numeric_columns() + ([REGION] if features.region else [])
    return [*stages, VectorAssembler(inputCols=inputs, outputCol=VECTOR, handleInvalid="keep")]


def design_matrix(df: DataFrame, features: FeatureSet, labels: list[str] | None = None) -> DataFrame:
    """Complete rows with the feature vector and the log1p target."""
    clean = features.complete_rows(df)
    model = Pipeline(stages=encoder_stages(features, labels)).fit(clean)
    return model.transform(clean).withColumn("y", F.log1p(features.target)).drop("_region_idx", REGION)


def fit(train: DataFrame, features: FeatureSet, model: str, params: dict | None = None) -> PipelineModel:
    """Encoder and regressor fitted on the given rows only."""
    labelled = features.complete_rows(train).withColumn(LABEL, F.log1p(F.col(features.target)))
    return Pipeline(stages=[*encoder_stages(features), make_regressor(model, params)]).fit(labelled)


def to_cases(raw: Column, features: FeatureSet, population: Column | None = None) -> Column:
    """Model output back to non-negative cases."""
    value = F.greatest(F.expm1(null_nan(raw)), F.lit(0.0))
    if not features.is_rate:
        return value
    return rate_to_count(value, F.col("populacao") if population is None else population)


def predict(model: PipelineModel, df: DataFrame, features: FeatureSet) -> DataFrame:
    scored = model.transform(features.complete_rows(df))
    keep = [c for c in df.columns]
    return scored.select(*keep, to_cases(F.col(RAW), features).alias("prediction"))


@dataclass(frozen=True)
class FitResult:
    """A fitted model with its lazy prediction and metric tables."""

    model: PipelineModel
    predictions: DataFrame
    features: FeatureSet

    @property
    def metrics(self) -> DataFrame:
        return consolidated(self.predictions)

    @property
    def region_metrics(self) -> DataFrame:
        return region_metrics(self.predictions)


PREDICTION_COLS = ("epi_sunday", "ra", "cases", "incidencia_100k", "populacao", "prediction")


def fit_and_predict(
    panel: DataFrame, features: FeatureSet, model: str, params: dict | None = None, test_year: int = 2025, open_end: bool = False
) -> FitResult:
    """Fit on the years before ``test_year`` and predict that year."""
    train, test = year_split(panel, test_year, open_end=open_end)
    fitted = fit(train, features, model, params)
    scored = predict(fitted, test, features)
    return FitResult(fitted, scored.select(*PREDICTION_COLS), features)


def importances(fitted: PipelineModel, features: FeatureSet, top: int = 15) -> list[tuple[str, float]]:
    """Largest numeric importances, region dummies left out, rescaled to sum 1."""
    values = fitted.stages[-1].featureImportances.toArray()
    numeric = list(zip(features.numeric_columns(), values))
    total = sum(v for _, v in numeric) or 1.0
    return sorted(((n, float(v / total)) for n, v in numeric), key=lambda x: (-x[1], x[0]))[:top]
