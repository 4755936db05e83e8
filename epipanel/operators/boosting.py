"""Second-order boosted trees: one aggregate of histograms a level, for many models at once.

A row carries its binned inputs and, for each model, its target (null where the model does not train on the
row) and its margin. A level of all models' trees is one job: every task sums gradients and weights over
(model, node, input, bin), the sums of a (model, node) meet in one place, and the best cut of each node comes
to the driver, which holds the trees alone. So folds, grid points, labels and input sets of an experiment
share their passes. Trees grown since the last cut of lineage go along with the job; every ``CUT_EVERY``
rounds the margins are written to the shared folder.

Squared error: the gradient is margin - target, the second derivative 1. A leaf is
-rate * G / (H + penalty). Cuts are values of the inputs: all of them up to ``BINS`` - 1, else approximate
percentiles over the rows that any model trains on.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epipanel.operators.forests import Forest
from epipanel.session import scratch

BINS = 256
CUT_EVERY = 10
ROWS_A_TASK = 50_000
BYTES_A_TASK = 1 << 25
LEAST_CHANGE = 1e-6


@dataclass(frozen=True)
class Boosting:
    """``columns`` is the share of inputs that each tree may use, ``rows`` that of rows it is grown on."""

    rounds: int = 200
    rate: float = 0.05
    depth: int = 4
    penalty: float = 1.0
    least_weight: float = 1.0
    least_gain: float = 0.0
    columns: float = 1.0
    rows: float = 1.0
    seed: int = 42


@dataclass(frozen=True)
class Job:
    """A model of a batch: target, the rows it trains on and the places of the inputs it may use (``None``: all)."""

    target: Column
    where: Column
    params: Boosting = Boosting()
    inputs: tuple[int, ...] | None = None


@dataclass
class Tree:
    """A tree in level order: children of k are 2k + 1 and 2k + 2; ``feature`` is -1 at leaves."""

    feature: np.ndarray
    code: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, int), np.zeros(n))

    def node_of(self, binned: np.ndarray, levels: int) -> np.ndarray:
        node, rows = np.zeros(len(binned), int), np.arange(len(binned))
        for _ in range(levels):
            feature = self.feature[node]
            right = binned[rows, np.maximum(feature, 0)] > self.code[node]
            node = np.where(feature >= 0, 2 * node + 1 + right, node)
        return node


def cut_values(rows: DataFrame, width: int) -> list[np.ndarray]:
    """Ascending cuts of every input; at most ``BINS`` - 1 numbers an input come to the driver."""
    long = rows.select(F.posexplode("x").alias("input", "v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    distinct = long.groupBy("input", "v").agg(F.lit(1).alias("one"))
    few = distinct.groupBy("input").agg(F.count("*").alias("n")).where(F.col("n") < BINS)
    whole = distinct.join(few, "input", "left_semi").groupBy("input").agg(F.collect_list("v").alias("cuts"))
    shares = F.lit([k / BINS for k in range(1, BINS)])
    spread = long.join(few, "input", "left_anti").groupBy("input").agg(F.percentile_approx("v", shares, 20 * BINS).alias("cuts"))
    out = [np.zeros(0)] * width
    for row in whole.unionByName(spread).collect():
        out[row["input"]] = np.unique(np.array(row["cuts"], float))
    return out


def binned_rows(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], axis=1).astype(np.uint8)


def listed(column: pa.Array, width: int) -> np.ndarray:
    """A column of equally long lists as a matrix; null entries are NaN."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(-1, width)


def as_lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width), pa.int32()), pa.array(values.ravel()))


STATE = "codes binary, y array<double>, margin array<double>, rid long"
HISTOGRAM = "model int, node int, sums binary"
CUT = "model int, node int, feature int, code int, gain double, g double, h double, left_g double, left_h double"


class Level:
    """What the tasks of a level's job need."""

    def __init__(self, params: list[Boosting], done: list[list[Tree]], open_: list[Tree], level: int, round_: int, offsets: np.ndarray, total: int, parts: int):
        self.params, self.done, self.open, self.level, self.round = params, done, open_, level, round_
        self.offsets, self.total, self.parts = offsets, total, parts

    def read(self, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        models, width = len(self.params), len(self.offsets)
        codes = np.frombuffer(b"".join(part.column("codes").to_pylist()), np.uint8).reshape(-1, width)
        y, margin = listed(part.column("y"), models), listed(part.column("margin"), models).copy()
        for m, trees in enumerate(self.done):
            for tree in trees:
                margin[:, m] += tree.value[tree.node_of(codes, self.params[m].depth)]
        return codes, y, margin, part.column("rid").to_numpy().astype(np.uint64)

    def drawn(self, rid: np.ndarray, m: int) -> np.ndarray:
        """Rows that the round's tree of a model is grown on, by a hash of row, round and model."""
        share = self.params[m].rows
        if share >= 1.0:
            return np.ones(len(rid), bool)
        with np.errstate(over="ignore"):
            h = (rid ^ np.uint64((self.round * 1000003 + m) * 2654435761 % 2**63)) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (h >> np.uint64(11)).astype(float) / 2**53 < share

    def sums(self, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, many = 2**self.level - 1, 2**self.level
        held: dict[int, np.ndarray] = {}
        for part in parts:
            if not part.num_rows:
                continue
            codes, y, margin, rid = self.read(part)
            place = codes.astype(np.int64) + self.offsets
            for m, tree in enumerate(self.open):
                if self.level >= self.params[m].depth:
                    continue
                node = tree.node_of(codes, self.level) - first
                own = np.flatnonzero(~np.isnan(y[:, m]) & (node >= 0) & self.drawn(rid, m))
                if not len(own):
                    continue
                key = (node[own, None] * self.total + place[own]).ravel()
                g = np.repeat(margin[own, m] - y[own, m], place.shape[1])
                both = held.setdefault(m, np.zeros((2, many * self.total)))
                both[0] += np.bincount(key, g, many * self.total)
                both[1] += np.bincount(key, minlength=many * self.total)
        rows = []
        for m, both in held.items():
            cut = both.reshape(2, many, self.total)
            rows += [(m, k, np.ascontiguousarray(cut[:, k]).tobytes()) for k in range(many) if cut[1, k].any()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary()))], names=["model", "node", "sums"])

    def best(self, sums: np.ndarray, m: int, allowed: np.ndarray, sizes: np.ndarray) -> tuple:
        """Feature, code, gain and sums of a node's best cut; of equal ones the first input's lowest."""
        p, (g, h) = self.params[m], sums
        starts = self.offsets
        first = slice(starts[0], starts[0] + sizes[0])
        total_g, total_h = g[first].sum(), h[first].sum()
        left = [np.cumsum(v) for v in (g, h)]
        left_g, left_h = (c - np.repeat(c[starts] - v[starts], sizes) for c, v in zip(left, (g, h)))
        right_g, right_h = total_g - left_g, total_h - left_h
        gain = left_g**2 / (left_h + p.penalty) + right_g**2 / (right_h + p.penalty) - total_g**2 / (total_h + p.penalty)
        open_ = np.repeat(allowed, sizes) & (left_h >= p.least_weight) & (right_h >= p.least_weight) & (left_h > 0) & (right_h > 0)
        gain = np.where(open_, gain, -np.inf)
        at = int(gain.argmax())
        if not gain[at] > max(LEAST_CHANGE, 2 * p.least_gain):
            return -1, 0, 0.0, float(total_g), float(total_h), 0.0, 0.0
        feature = int(np.searchsorted(starts, at, side="right")) - 1
        return feature, at - int(starts[feature]), float(gain[at]), float(total_g), float(total_h), float(left_g[at]), float(left_h[at])


def fit_many(rows: DataFrame, jobs: list[Job]) -> list[Forest]:
    """One ensemble for each job. ``rows`` has the inputs as an array ``x`` besides what the jobs' columns need.

    A job without a training row gives an ensemble that predicts NaN.
    """
    if not jobs:
        return []
    params = [j.params for j in jobs]
    targets = F.array(*(F.when(j.where, j.target.cast("double")) for j in jobs))
    with scratch(rows.sparkSession, "boosting") as folder:
        used = rows.select("x", targets.alias("y")).where(F.exists("y", lambda v: v.isNotNull()))
        used.write.parquet(f"{folder}/rows")
        used = rows.sparkSession.read.schema(used.schema).parquet(f"{folder}/rows")
        n, width, *means = used.agg(F.count("*"), F.max(F.size("x")), *(F.avg(F.get("y", k)) for k in range(len(jobs)))).first()
        if not n:
            return [constant(float("nan"))] * len(jobs)
        cuts = cut_values(used, width)
        start = np.array([np.nan if v is None else v for v in means])
        forests = grow(used, -(-n // ROWS_A_TASK), folder, cuts, params, [j.inputs for j in jobs], start)
    return forests


def grow(used: DataFrame, parts: int, folder: str, cuts: list[np.ndarray], params: list[Boosting], inputs: list[tuple[int, ...] | None], start: np.ndarray) -> list[Forest]:
    spark, width = used.sparkSession, len(cuts)
    sizes = np.array([len(c) + 1 for c in cuts])
    offsets, total = np.cumsum(sizes) - sizes, int(sizes.sum())
    models = range(len(params))

    def prepared(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            codes = binned_rows(listed(part.column("x"), width), cuts)
            margin = np.repeat(start[None, :], part.num_rows, axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([c.tobytes() for c in codes], pa.binary()), part.column("y"), as_lists(margin), part.column("rid")], names=["codes", "y", "margin", "rid"]
            )

    def written(frame: DataFrame, name: int) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.schema(STATE).parquet(f"{folder}/{name}")

    state = written(used.repartition(parts).withColumn("rid", F.xxhash64("x", "y")).mapInArrow(prepared, STATE), 0)
    trees: list[list[Tree]] = [[] for _ in models]
    since: list[list[Tree]] = [[] for _ in models]
    draws = [np.random.default_rng((p.seed, m)) for m, p in enumerate(params)]
    for round_ in range(max(p.rounds for p in params)):
        live = [m for m in models if round_ < params[m].rounds and not np.isnan(start[m])]
        allowed = {m: drawn_inputs(width, inputs[m], params[m].columns, draws[m]) for m in live}
        open_ = [Tree.empty(p.depth) for p in params]
        for level in range(max((params[m].depth for m in live), default=0)):
            shown = [p if m in allowed else Boosting(depth=0) for m, p in enumerate(params)]
            now = Level(shown, since, open_, level, round_, offsets, total, parts)
            if not settle(now, best_cuts(state, now, allowed, sizes)):
                break
        for m in live:
            trees[m].append(open_[m])
            since[m].append(open_[m])
        if (round_ + 1) % CUT_EVERY == 0:
            state = written(moved(state, Level(params, since, open_, 0, round_, offsets, total, parts)), round_ + 1)
            since = [[] for _ in models]
    return [forest_of(start[m], trees[m], cuts, params[m].depth) for m in models]


def drawn_inputs(width: int, inputs: tuple[int, ...] | None, share: float, draw: np.random.Generator) -> np.ndarray:
    """Inputs that a tree may use: ``share`` of those of its model, one at least."""
    own = np.arange(width) if inputs is None else np.array(inputs, int)
    if share < 1.0:
        own = draw.choice(own, max(1, int(share * len(own))), replace=False)
    allowed = np.zeros(width, bool)
    allowed[own] = True
    return allowed


def best_cuts(state: DataFrame, level: Level, allowed: dict[int, np.ndarray], sizes: np.ndarray) -> list:
    """The best cut of every node of a level: one job, one row a node."""

    def settled(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, rows = None, None, []
        for part in parts:
            for m, node, data in zip(*(part.column(c).to_pylist() for c in ("model", "node", "sums")), strict=True):
                sums = np.frombuffer(data).reshape(2, level.total)
                if key == (m, node):
                    held = held + sums
                    continue
                if key is not None:
                    rows.append((*key, *level.best(held, key[0], allowed[key[0]], sizes)))
                key, held = (m, node), sums
        if key is not None:
            rows.append((*key, *level.best(held, key[0], allowed[key[0]], sizes)))
        if rows:
            kinds = (pa.int32(),) * 4 + (pa.float64(),) * 5
            names = ["model", "node", "feature", "code", "gain", "g", "h", "left_g", "left_h"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)], names=names)

    summed = state.mapInArrow(level.sums, HISTOGRAM)
    nodes = len(allowed) * 2**level.level
    tasks = max(1, min(nodes, nodes * level.total * 16 * level.parts // BYTES_A_TASK))
    return summed.repartition(tasks, "model", "node").sortWithinPartitions("model", "node").mapInArrow(settled, CUT).collect()


def settle(level: Level, rows: list) -> bool:
    """Put a level's cuts and the values of what they make into the open trees; whether any node was cut."""
    first, any_cut = 2**level.level - 1, False
    for r in rows:
        p, tree, node = level.params[r["model"]], level.open[r["model"]], first + r["node"]
        value = lambda g, h: -p.rate * g / (h + p.penalty)
        if level.level == 0:
            tree.value[0] = value(r["g"], r["h"])
        if r["feature"] < 0:
            continue
        any_cut = True
        tree.feature[node], tree.code[node] = r["feature"], r["code"]
        tree.value[2 * node + 1] = value(r["left_g"], r["left_h"])
        tree.value[2 * node + 2] = value(r["g"] - r["left_g"], r["h"] - r["left_h"])
    return any_cut


def moved(state: DataFrame, level: Level) -> DataFrame:
    """The state with the closed trees added to its margins."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                margin = level.read(part)[2]
                yield pa.RecordBatch.from_arrays([part.column("codes"), part.column("y"), as_lists(margin), part.column("rid")], names=["codes", "y", "margin", "rid"])

    return state.mapInArrow(run, STATE)


def constant(value: float) -> Forest:
    whole = np.zeros((1, 1), int)
    return Forest(whole, whole.astype(float), whole.astype(bool), whole, whole, np.full((1, 1), value), np.ones(1))


def forest_of(start: float, trees: list[Tree], cuts: list[np.ndarray], depth: int) -> Forest:
    """Trees as flat arrays, the start value as a tree of one leaf."""
    n = 2 ** (depth + 1) - 1
    feature = np.vstack([np.full((1, n), -1), *(t.feature for t in trees)]).astype(int)
    code = np.vstack([np.zeros((1, n), int), *(t.code for t in trees)]).astype(int)
    value = np.vstack([np.full((1, n), start), *(t.value for t in trees)])
    leaf = feature < 0
    own = np.broadcast_to(np.arange(n), feature.shape)
    cut = np.zeros(feature.shape)
    for t, k in zip(*np.nonzero(~leaf)):
        cut[t, k] = cuts[feature[t, k]][code[t, k]]
    return Forest(
        np.where(leaf, 0, feature), cut, np.zeros(feature.shape, bool), np.where(leaf, own, 2 * own + 1), np.where(leaf, own, 2 * own + 2), value, np.ones(len(feature))
    )


def scores(rows: DataFrame, forests: list[Forest], job: str = "job", out: str = "raw") -> DataFrame:
    """``rows`` (with inputs ``x``) and the output of the ensemble that column ``job`` numbers."""
    shared = rows.sparkSession.sparkContext.broadcast(forests)

    @F.pandas_udf("double")
    def scored(x: pd.Series, which: pd.Series) -> pd.Series:
        values = np.full(len(x), np.nan)
        for k in which.unique():
            own = (which == k).to_numpy()
            values[own] = shared.value[int(k)].predict(np.vstack(x[own].to_numpy()))
        return pd.Series(values)

    return rows.withColumn(out, scored("x", F.col(job)))


# as a stage of a pipeline


class _BoostingParams(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector of inputs", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "target", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "output", TypeConverters.toString)

    def getFeaturesCol(self) -> str:
        return self.getOrDefault(self.featuresCol)

    def getLabelCol(self) -> str:
        return self.getOrDefault(self.labelCol)

    def getPredictionCol(self) -> str:
        return self.getOrDefault(self.predictionCol)


class BoostedRegressor(Estimator, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """The ensemble of one job as a pipeline stage."""

    settings = Param(Params._dummy(), "settings", "parameters as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction", settings: str = "{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def params_(self) -> Boosting:
        return Boosting(**json.loads(self.getOrDefault(self.settings)))

    def getMaxIter(self) -> int:
        return self.params_.rounds

    def getMaxDepth(self) -> int:
        return self.params_.depth

    def getStepSize(self) -> float:
        return self.params_.rate

    def _fit(self, dataset: DataFrame) -> BoostedModel:
        rows = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).alias("_y"))
        forest = fit_many(rows, [Job(F.col("_y"), F.col("_y").isNotNull(), self.params_)])[0]
        return BoostedModel(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol(), trees=written_out(forest))


def written_out(forest: Forest) -> str:
    return json.dumps({k: getattr(forest, k).tolist() for k in Forest.__dataclass_fields__})


class BoostedModel(Model, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted ensemble; its trees are saved with the stage's parameters."""

    trees = Param(Params._dummy(), "trees", "flat trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction", trees: str = ""):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def forest(self) -> Forest:
        kinds = {"feature": int, "left": int, "right": int, "swapped": bool}
        return Forest(**{k: np.array(v, kinds.get(k, float)) for k, v in json.loads(self.getOrDefault(self.trees)).items()})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared = dataset.sparkSession.sparkContext.broadcast(self.forest)

        @F.pandas_udf("double")
        def scored(x: pd.Series) -> pd.Series:
            return pd.Series(shared.value.predict(np.vstack(x.to_numpy())) if len(x) else np.zeros(0))

        return dataset.withColumn(self.getPredictionCol(), scored(vector_to_array(self.getFeaturesCol())))
