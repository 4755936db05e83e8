"""Closed multi-step forecasts: lags come from the model's own predictions.

Each series is one row that carries its recent values and its future inputs as
arrays. With trees, one narrow job steps a whole batch of series at once on the
flattened model; other models advance by a projection and their transform a
step. Neither shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from epipanel.functions.scalars import per_100k, ratio
from epipanel.operators import forests
from epipanel.operators.learners import LABEL, RAW, REGION, VECTOR, make_regressor, to_cases
from epipanel.operators.series import add_lags
from epipanel.operators.splits import last_weeks, year_split
from epipanel.plans.features import FeatureSet
from epipanel.session import reliable_checkpoint

CUT_EVERY = 13


def recent_values(train: DataFrame, key: str, week: str, value: str, count: int) -> DataFrame:
    """(key, hist): the last ``count`` values, oldest first."""
    pairs = F.sort_array(F.collect_list(F.struct(week, F.col(value).alias("v"))))
    recent = last_weeks(train, count, week)
    return recent.groupBy(key).agg(F.transform(pairs, lambda p: p["v"]).alias("hist"))


def unroll(
    state: DataFrame,
    key: str,
    steps: int,
    inputs: Callable[[Column, Column], dict[str, Column]],
    regressor: Transformer,
    value: Callable[[Column, Column], Column],
    fixed: str | None = None,
) -> DataFrame:
    """Advance every series ``steps`` times; adds array column ``preds``.

    ``state`` has ``key``, ``hist`` (recent values) and ``fut`` (array of
    structs, one per step); ``fixed`` names an array of inputs that do not
    change. A step whose inputs are incomplete predicts null and leaves the
    history as it is.
    """
    keep = [key, "fut", *([fixed] if fixed else [])]
    state = state.withColumn("preds", F.array().cast("array<double>"))
    for k in range(steps):
        row = F.get("fut", F.lit(k))
        cols = [c.cast("double") for c in inputs(row, F.col("hist")).values()]
        ready = row.isNotNull()
        for c in cols:
            ready = ready & c.isNotNull()
        values = F.array(*[F.coalesce(c, F.lit(0.0)) for c in cols])
        vector = array_to_vector(F.concat(values, fixed) if fixed else values)
        scored = regressor.transform(state.select(*keep, "hist", "preds", ready.alias("_ready"), vector.alias(VECTOR)))
        guess = F.when(F.col("_ready"), value(F.col(RAW), row))
        moved = F.concat(F.slice("hist", 2, F.size("hist") - 1), F.array(guess))
        state = scored.select(
            *keep,
            F.when(F.col("_ready"), moved).otherwise(F.col("hist")).alias("hist"),
            F.concat("preds", F.array(guess)).alias("preds"),
        )
        if (k + 1) % CUT_EVERY == 0:
            state = reliable_checkpoint(state)
    return state


Arrays = dict[str, np.ndarray]


def unroll_trees(
    state: DataFrame,
    key: str,
    steps: int,
    names: list[str],
    outside: list[str],
    own: Callable[[np.ndarray, Arrays], Arrays],
    forest: forests.Forest,
    value: Callable[[np.ndarray, Arrays], np.ndarray],
    fixed: str | None = None,
) -> DataFrame:
    """As ``unroll`` for a tree model, in one job: key, fut and ``preds``.

    ``names`` are the model's inputs in order; ``own`` derives some from the
    history (series x places) and the step's ``outside`` fields of ``fut``, the
    others are those fields. Missing values are NaN.
    """
    sent = state.sparkSession.sparkContext.broadcast(forest)
    kept = [key, "hist", "fut", *([fixed] if fixed else [])]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            n = part.num_rows
            if not n:
                continue
            past = part.column("hist").to_pylist()
            hist = np.full((n, max(map(len, past))), np.nan)
            for row, values in zip(hist, past, strict=True):
                if values:
                    row[-len(values) :] = [np.nan if v is None else v for v in values]
            future = part.column("fut")
            sizes = pc.list_value_length(future).to_numpy(zero_copy_only=False).astype(int)
            there = np.arange(steps)[None, :] < sizes[:, None]
            inside = np.arange(sizes.max(initial=0))[None, :] < sizes[:, None]
            fields = {}
            flat = future.flatten()
            for name in outside:
                padded = np.full((n, max(steps, inside.shape[1])), np.nan)
                padded[:, : inside.shape[1]][inside] = flat.field(name).cast(pa.float64()).to_numpy(zero_copy_only=False)
                fields[name] = padded
            still = np.array(part.column(fixed).to_pylist(), float) if fixed else np.zeros((n, 0))
            preds = np.full((n, steps), np.nan)
            for k in range(steps):
                row = {name: values[:, k] for name, values in fields.items()}
                derived = own(hist, row)
                x = np.column_stack([derived.get(c, row.get(c)) for c in names])
                ready = there[:, k] & ~np.isnan(x).any(axis=1)
                guess = np.full(n, np.nan)
                if ready.any():
                    raw = sent.value.predict(np.hstack([x, still])[ready])
                    guess[ready] = value(raw, {name: v[ready] for name, v in row.items()})
                hist[ready] = np.column_stack([hist[ready, 1:], guess[ready]])
                preds[:, k] = guess
            values = pa.array(preds.ravel(), mask=np.isnan(preds.ravel()))
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, n * steps + 1, steps), pa.int32()), values)
            yield pa.RecordBatch.from_arrays([part.column(key), future, listed], names=[key, "fut", "preds"])

    kinds = {f.name: f.dataType for f in state.schema}
    schema = StructType([StructField(key, kinds[key]), StructField("fut", kinds["fut"]), StructField("preds", ArrayType(DoubleType()))])
    return state.select(*kept).mapInArrow(run, schema)


def recursive_forecast(panel: DataFrame, fitted: PipelineModel, features: FeatureSet, test_year: int) -> DataFrame:
    """Predictions of the test year where case lags, deltas and growth are all
    recomputed from earlier predictions; climate and season stay as given."""
    train, test = year_split(panel, test_year)
    steps = test.select("epi_sunday").distinct().count()
    outside = [c for c in features.numeric_columns() if c in panel.columns]
    future = test.groupBy("ra").agg(
        F.sort_array(F.collect_list(F.struct("epi_sunday", "cases", "incidencia_100k", "populacao", *[c for c in outside if c != "populacao"]))).alias("fut")
    )
    state = future.join(recent_values(train, "ra", "epi_sunday", "cases", 4), "ra")
    fixed = None
    if features.region:
        for stage in fitted.stages[:2]:
            state = stage.transform(state)
        fixed = "_region_values"
        state = state.withColumn(fixed, vector_to_array(REGION)).drop("_region_idx", REGION)

    def inputs(row: Column, hist: Column) -> dict[str, Column]:
        lag = {n: F.try_element_at(hist, F.lit(-n)) for n in range(1, 5)}
        own = {f"cases_lag_{n}": lag[n] for n in lag}
        own |= {f"incidencia_100k_lag_{n}": per_100k(lag[n], row["populacao"]) for n in lag}
        own |= {
            "cases_delta_1": lag[1] - lag[2],
            "cases_delta_2": lag[2] - lag[3],
            "cases_growth_rate": ratio(lag[1] + 1.0, lag[2] + 1.0),
        }
        return {c: own[c] if c in own else row[c] for c in features.numeric_columns()}

    def value(raw: Column, row: Column) -> Column:
        return to_cases(raw, features, row["populacao"])

    regressor = fitted.stages[-1]
    if forests.can_flatten(regressor):
        rate, names = features.is_rate, features.numeric_columns()
        done = unroll_trees(
            state, "ra", steps, names, ["populacao", *[c for c in outside if c != "populacao"]], case_inputs,
            forests.flatten(panel.sparkSession, regressor), lambda raw, row: cases_from(raw, row["populacao"] if rate else None), fixed,
        )
    else:
        done = unroll(reliable_checkpoint(state), "ra", steps, inputs, regressor, value, fixed)
    paired = F.arrays_zip(F.slice("fut", F.lit(1), F.size("preds")), F.col("preds"))
    rows = done.select("ra", F.explode(paired).alias("_z"))
    fut, pred = rows.schema["_z"].dataType.names
    got = rows.select("ra", F.col("_z")[fut].alias("_f"), F.col("_z")[pred].alias("prediction"))
    return got.select(
        F.col("_f.epi_sunday").alias("epi_sunday"), "ra", F.col("_f.cases").alias("cases"),
        F.col("_f.incidencia_100k").alias("incidencia_100k"), F.col("_f.populacao").alias("populacao"), "prediction",
    ).filter("prediction is not null")


def past_value(hist: np.ndarray, n: int) -> np.ndarray:
    return hist[:, -n] if n <= hist.shape[1] else np.full(len(hist), np.nan)


def safe_ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.full(len(a), np.nan), where=b != 0)


def case_inputs(hist: np.ndarray, row: Arrays) -> Arrays:
    """Lags, rates, deltas and growth from a history of predictions."""
    lag = {n: past_value(hist, n) for n in range(1, 5)}
    own = {f"cases_lag_{n}": v for n, v in lag.items()}
    own |= {f"incidencia_100k_lag_{n}": safe_ratio(v, row["populacao"]) * 100000.0 for n, v in lag.items()}
    return own | {
        "cases_delta_1": lag[1] - lag[2],
        "cases_delta_2": lag[2] - lag[3],
        "cases_growth_rate": safe_ratio(lag[1] + 1.0, lag[2] + 1.0),
    }


def cases_from(raw: np.ndarray, population: np.ndarray | None) -> np.ndarray:
    """Model output back to non-negative cases; NaN where it is not finite."""
    value = np.maximum(np.expm1(raw), 0.0)
    value[~np.isfinite(raw)] = np.nan
    return value if population is None else value * population / 100000.0


SERIES_LAGS = (1, 4, 8, 13, 26, 52)


def global_model(train: DataFrame, horizon: int, params: dict | None = None, lags=SERIES_LAGS) -> tuple[PipelineModel, DataFrame]:
    """One boosted model over all series with lags, week and month; returns the
    model and a recursive forecast (unique_id, ds, h, prediction)."""
    names = [f"y_lag_{n}" for n in lags] + ["week", "month"]
    framed = add_lags(train, ["unique_id"], "ds", ["y"], lags).withColumns(
        {"week": F.weekofyear("ds"), "month": F.month("ds")}
    )
    rows = framed.dropna(subset=names).withColumn(LABEL, F.col("y"))
    assembler = VectorAssembler(inputCols=names, outputCol=VECTOR, handleInvalid="keep")
    fitted = Pipeline(stages=[assembler, make_regressor("XGB", params)]).fit(rows)
    weeks = F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda i: F.date_add("_last", i * 7))
    ends = train.groupBy("unique_id").agg(F.max("ds").alias("_last")).select(
        "unique_id", F.transform(weeks, lambda d: F.struct(d.alias("ds"), F.weekofyear(d).alias("week"), F.month(d).alias("month"))).alias("fut")
    )
    state = ends.join(recent_values(train, "unique_id", "ds", "y", max(lags)), "unique_id")

    def inputs(row: Column, hist: Column) -> dict[str, Column]:
        own = {f"y_lag_{n}": F.try_element_at(hist, F.lit(-n)) for n in lags}
        return {**own, "week": row["week"], "month": row["month"]}

    regressor = fitted.stages[-1]
    if forests.can_flatten(regressor):
        done = unroll_trees(
            state, "unique_id", horizon, names, ["week", "month"], lambda hist, _row: {f"y_lag_{n}": past_value(hist, n) for n in lags},
            forests.flatten(train.sparkSession, regressor), lambda raw, _row: raw,
        )
    else:
        done = unroll(reliable_checkpoint(state), "unique_id", horizon, inputs, regressor, lambda raw, _row: raw)
    ahead = done.select("unique_id", "fut", F.posexplode("preds").alias("_i", "prediction"))
    return fitted, ahead.select(
        "unique_id", F.get("fut", F.col("_i"))["ds"].alias("ds"), (F.col("_i") + 1).alias("h"), "prediction"
    )
