from __future__ import annotations

import os
import shutil
import tempfile

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lendscape.operators import boosting, histograms


@pytest.fixture(autouse=True)
def any_number_of_rows(monkeypatch):
    monkeypatch.setattr(histograms, "FROM_ROWS", 0)


@pytest.fixture(scope="module")
def matrix(spark):
    """A weighted, noisy label on numbers, zeros, few values and a category."""
    rng = np.random.default_rng(11)
    n = 3000
    x, few, kind = rng.normal(size=(n, 2)), rng.integers(0, 4, n), rng.integers(0, 5, n)
    zeros = np.where(rng.random(n) < 0.5, 0.0, rng.random(n))
    y = (x[:, 0] + zeros + (kind == 3) * few + rng.normal(size=n) > 1).astype(int)
    rows = [(int(a), float(b[0]), float(b[1]), int(c), float(d), f"k{e}") for a, b, c, d, e in zip(y, x, few, zeros, kind)]
    df = spark.createDataFrame(rows, "y int, a double, b double, c int, d double, k string").withColumn("w", F.when(F.col("y") == 1, 1.7).otherwise(1.0))
    coded = StringIndexer(inputCol="k", outputCol="code").fit(df).transform(df)
    return VectorAssembler(inputCols=["a", "b", "c", "d", "code"], outputCol="x").transform(coded).select("y", "w", "x").repartition(3).cache()


def booster(rounds, depth=4):
    return GBTClassifier(labelCol="y", featuresCol="x", weightCol="w", maxIter=rounds, maxDepth=depth, maxBins=16, stepSize=0.2, seed=3)


def probabilities(model, df):
    return np.array([r.p for r in model.transform(df).select("x", vector_to_array("probability")[1].alias("p")).collect()])


def test_trees_are_those_of_mllib(matrix, folder):
    grower = histograms.Grower(matrix, booster(12))
    first, model = grower.grow(5), grower.grow(12)
    grower.close()
    plain = booster(12).fit(matrix)
    assert first.getNumTrees == 5 and model.getNumTrees == 12 and model.treeWeights == plain.treeWeights
    assert np.abs(probabilities(model, matrix) - probabilities(plain, matrix)).max() < 1e-9
    assert np.abs(probabilities(first, matrix) - probabilities(boosting.first_rounds(plain, 5), matrix)).max() < 1e-9
    assert np.abs(model.featureImportances.toArray() - plain.featureImportances.toArray()).max() < 1e-6
    model.write().overwrite().save(f"{folder}/model")
    assert (probabilities(type(model).load(f"{folder}/model"), matrix) == probabilities(model, matrix)).all()


def test_boosting_leaves_the_rounds_to_histograms(matrix, monkeypatch):
    def refuse(self, *args):
        raise AssertionError("MLlib walks all rows in every round")

    monkeypatch.setattr(GBTClassifier, "fit", refuse)
    model = boosting.boost(matrix, matrix.where("x IS NOT NULL"), booster(6, 2), "y", patience=2)
    assert model.getNumTrees == 6


def test_lost_files_are_made_anew(matrix):
    grower, whole = histograms.Grower(matrix, booster(6)), histograms.Grower(matrix, booster(6))
    wanted = probabilities(whole.grow(6), matrix)
    grower.grow(3)
    held = os.path.join(tempfile.gettempdir(), f"lendscape-{grower.name}")
    shutil.rmtree(held)  # by the test: a machine was lost
    assert np.abs(probabilities(grower.grow(5), matrix) - probabilities(whole._model(), matrix)).max() > 0
    os.remove(next(os.path.join(d, f) for d, _, files in os.walk(held) for f in files if f.startswith("margin")))
    assert np.abs(probabilities(grower.grow(6), matrix) - wanted).max() < 1e-12
    for one in (grower, whole):
        one.close()
    assert not os.path.exists(held)


def test_rows_in_many_partitions(matrix):
    many = matrix.repartition(40)
    grower = histograms.Grower(many, booster(4))
    found = probabilities(grower.grow(4), matrix)
    grower.close()
    assert np.abs(found - probabilities(booster(4).fit(many), matrix)).max() < 1e-9


def test_what_histograms_do_not_cover_goes_to_mllib(matrix):
    sampled = booster(2).setSubsamplingRate(0.5)
    assert histograms.Grower(matrix, sampled).plan is None
    uneven = matrix.withColumn("w", vector_to_array("x")[2] + 1)
    grower = histograms.Grower(uneven, booster(2))
    assert grower.plan is None and grower.grow(2).getNumTrees == 2


def test_few_rows_are_left_to_mllib(matrix, monkeypatch):
    monkeypatch.setattr(histograms, "FROM_ROWS", 3001)
    assert histograms.Grower(matrix, booster(2)).plan is None


def test_no_number_is_refused(matrix):
    strange = matrix.withColumn("x", F.when(F.rand(1) < 0.01, F.lit(None)).otherwise(F.col("x")))
    with pytest.raises(Exception):
        histograms.Grower(strange, booster(2)).grow(2)


def test_candidate_splits():
    weights = np.ones(8)
    assert histograms.thresholds(np.zeros(8), weights, 8.0, 3).tolist() == []
    assert histograms.thresholds(np.array([0, 0, 1, 1, 2, 2, 3, 3.0]), weights, 8.0, 3).tolist() == [0.5, 1.5, 2.5]
    assert histograms.thresholds(np.arange(1, 9.0), weights, 8.0, 3).tolist() == [2.5, 4.5, 6.5]
