"""Fitted tree ensembles as flat arrays, so a task can score many rows and steps at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Transformer
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from epipanel.session import scratch


@dataclass(frozen=True)
class Forest:
    """Per tree and node: split, children (a leaf is its own child) and prediction."""

    feature: np.ndarray
    cut: np.ndarray
    swapped: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weights: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        trees, rows = np.arange(len(self.weights))[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.weights)), int)
        while True:
            goes_left = (x[rows, self.feature[trees, node]] <= self.cut[trees, node]) != self.swapped[trees, node]
            after = np.where(goes_left, self.left[trees, node], self.right[trees, node])
            if (after == node).all():
                return self.value[trees, node] @ self.weights
            node = after


def can_flatten(model: Transformer) -> bool:
    return isinstance(model, (RandomForestRegressionModel, GBTRegressionModel)) or hasattr(model, "forest")


def flatten(spark: SparkSession, model: Transformer) -> Forest:
    """The model's nodes, read from its saved form; as large as the model, whatever the data.

    Splits on two-valued columns name the values that go left; they become cuts at one half.
    """
    if hasattr(model, "forest"):
        return model.forest
    split = F.col("nodeData.split")
    with scratch(spark, "forest") as path:
        model.write().save(path)
        nodes = spark.read.parquet(f"{path}/data").select(
            "treeID", "nodeData.id", "nodeData.prediction", F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
            split["featureIndex"].alias("feature"), split["leftCategoriesOrThreshold"].alias("at"), split["numCategories"].alias("kinds"),
        ).toPandas()
    if (nodes["kinds"] > 2).any():
        raise ValueError("splits on columns of more than two categories are not supported")
    shape = (int(nodes["treeID"].max()) + 1, int(nodes["id"].max()) + 1)
    tree, node = nodes["treeID"].to_numpy(), nodes["id"].to_numpy()
    leaf = nodes["left"].to_numpy() < 0

    def table(values, kind) -> np.ndarray:
        out = np.zeros(shape, kind)
        out[tree, node] = values
        return out

    first = np.array([a[0] if len(a) else 0.0 for a in nodes["at"]])
    two = nodes["kinds"].to_numpy() == 2
    weights = np.array(model.treeWeights, float)
    return Forest(
        table(np.where(leaf, 0, nodes["feature"]), int),
        table(np.where(two, 0.5, first), float),
        table(two & (first == 1.0) & ~leaf, bool),
        table(np.where(leaf, node, nodes["left"]), int),
        table(np.where(leaf, node, nodes["right"]), int),
        table(nodes["prediction"], float),
        weights if isinstance(model, GBTRegressionModel) else weights / weights.sum(),
    )
