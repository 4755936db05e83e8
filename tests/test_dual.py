"""Logistic models kept as one number a row, against Spark's optimiser over the terms."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from epipanel.operators import dual, textmodels

SCHEMA = StructType([StructField("k", LongType()), StructField("a", IntegerType()), StructField("b", IntegerType()), StructField("features", VectorUDT())])


def rows(n, size, seed, first=0):
    """Sparse rows of unit length, among them copies, null keys, an empty row and a dense one."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        at = np.unique((size * rng.random(12) ** 3).astype(int))
        value = rng.random(len(at)) + 0.1
        value /= np.sqrt((value**2).sum())
        a = int(rng.random() < 0.2 + 0.6 * (at[0] < 2))
        out.append((first + i, a, int(rng.random() < 0.8), Vectors.sparse(size, at.tolist(), value.tolist())))
    dense = np.zeros(size)
    dense[3] = 1.0
    return [*out, out[0], (None, 1, 0, out[1][3]), (first + n, 0, 1, Vectors.sparse(size, [], [])), (first + n + 1, 0, 1, Vectors.dense(dense))]


@pytest.fixture(params=[200_000, 50])
def parts(request, monkeypatch):
    monkeypatch.setattr(dual, "PART_ENTRIES", request.param)
    monkeypatch.setattr(dual, "DEALT_ENTRIES", request.param)


def test_scores_are_those_of_the_optimum(spark, parts):
    train = spark.createDataFrame(rows(150, 400, 1), SCHEMA)
    other = spark.createDataFrame(rows(60, 400, 2, 1000), SCHEMA)
    got = textmodels.logistic_scores(train, other, "k", ["a", "b"])
    assert got.columns == ["k", "label", "score"]
    for label in ("a", "b"):
        weighed = textmodels.balanced_weights(train, label)
        exact = LogisticRegression(labelCol=label, weightCol="weight", regParam=1.0 / (4.0 * train.count()), maxIter=1000, tol=1e-14, standardization=False)
        want = exact.fit(weighed).transform(other).select("k", vector_to_array("probability")[1].alias("score"))
        order = lambda df: sorted(((-1 if r.k is None else r.k), r.score) for r in df.collect())
        x, y = order(got.filter(F.col("label") == label)), order(want)
        assert [k for k, _ in x] == [k for k, _ in y]
        assert np.allclose([s for _, s in x], [s for _, s in y], rtol=0, atol=1e-5)


def test_nothing_as_long_as_the_terms_comes_to_the_driver(spark, monkeypatch):
    """A pass is asked with, and answered by, one number a row; Spark's optimiser held some twenty vectors of 50 million."""
    asked, product = [], dual.product
    monkeypatch.setattr(dual, "product", lambda cells, numbers, vectors: asked.append([len(v) for v in vectors]) or product(cells, numbers, vectors))
    size = 50_000_000
    data = [(i, i % 2, 1 - i % 2, Vectors.sparse(size, [i % 3, size - 1 - i], [0.6, 0.8])) for i in range(40)]
    train = spark.createDataFrame(data, SCHEMA)
    got = textmodels.logistic_scores(train, train, "k", ["a", "b"]).collect()
    assert len(got) == 80 and all((r.score > 0.5) == (r.k % 2 == (r.label == "a")) for r in got)
    assert asked and all(n == 40 for ns in asked for n in ns)


def test_labels_of_one_class_and_missing_ones(spark):
    data = [(i, 1, 0, Vectors.sparse(4, [i % 4], [1.0])) for i in range(6)]
    train = spark.createDataFrame(data, SCHEMA)
    got = textmodels.logistic_scores(train, train, "k", ["a", "b"])
    assert {(r.label, r.score) for r in got.collect()} == {("a", 1.0), ("b", 0.0)}
    with pytest.raises(ValueError, match="a: every training row needs a label"):
        textmodels.logistic_scores(train.withColumn("a", F.when(F.col("k") > 0, F.col("a"))), train, "k", ["a"])


def test_the_fit_takes_few_passes(spark, monkeypatch):
    """Each pass reads the whole matrix; without a sketch of it this fit took 52 of them."""
    asked, product = [], dual.product
    monkeypatch.setattr(dual, "product", lambda cells, numbers, vectors: asked.append(len(vectors)) or product(cells, numbers, vectors))
    train = spark.createDataFrame(rows(600, 5000, 3), SCHEMA)
    textmodels.logistic_scores(train, train.limit(5), "k", ["a", "b"]).count()
    assert len(asked) <= 30
