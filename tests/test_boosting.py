from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from lendscape.operators import boosting


@pytest.fixture(scope="module")
def matrix(spark):
    """Noisy labels: more rounds help for a while only."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=1500) * 1.5 > 0).astype(int)
    rows = [(int(label), [float(v) for v in row], i % 5 == 0) for i, (label, row) in enumerate(zip(y, x))]
    df = spark.createDataFrame(rows, "y int, a array<double>, held boolean").repartition(3)
    return df.select("y", array_to_vector("a").alias("x"), "held").cache()


def booster(rounds, depth=3):
    return GBTClassifier(labelCol="y", featuresCol="x", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=3)


@pytest.fixture(scope="module")
def model(matrix):
    return booster(30).fit(matrix.where("NOT held"))


def plain_auc(labels, scores):
    pos, neg = scores[labels == 1], scores[labels == 0]
    return ((pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2) / (len(pos) * len(neg))


def test_auc_of_every_prefix(matrix, model):
    held = matrix.where("held")
    got = boosting.staged_auc(model, held, "y")
    assert len(got) == 30
    for k in (1, 2, 7, 30):
        rows = boosting.first_rounds(model, k).transform(held).select("y", vector_to_array("probability")[1].alias("p")).collect()
        labels, p = np.array([r.y for r in rows]), np.array([r.p for r in rows])
        assert got[k - 1] == pytest.approx(plain_auc(labels, np.floor(p * boosting.BINS)), abs=1e-9)
        assert got[k - 1] == pytest.approx(plain_auc(labels, p), abs=1e-3)


def test_cut_model_adds_up_its_trees(matrix, model, folder):
    cut = boosting.first_rounds(model, 4)
    assert cut.getNumTrees == 4 and cut.treeWeights == model.treeWeights[:4] and cut.getFeaturesCol() == "x"
    values = boosting.leaf_values(model)[:4]
    rows = model.copy().setLeafCol("leaves").transform(matrix).select("x", vector_to_array("leaves").alias("l")).limit(50).collect()
    for r in rows:
        margin = sum(values[k][int(leaf)] for k, leaf in enumerate(r.l[:4]))
        assert cut.predictRaw(r.x)[1] == pytest.approx(margin)
    cut.write().overwrite().save(f"{folder}/cut")
    again = type(cut).load(f"{folder}/cut")
    assert [again.predictRaw(r.x) for r in rows] == [cut.predictRaw(r.x) for r in rows]


def brute_best(aucs, patience):
    """Rounds a booster with patience runs, and the best among them."""
    ran = next((k for k in range(1, len(aucs) + 1) if k - 1 - int(np.argmax(aucs[:k])) >= patience), len(aucs))
    return int(np.argmax(aucs[:ran])) + 1, ran - 1 - int(np.argmax(aucs[:ran])) >= patience


def test_patience_against_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(300):
        aucs = rng.integers(0, 12, rng.integers(1, 30)).tolist()
        for patience in (1, 3, 20):
            assert boosting.best_round(aucs, patience) == brute_best(aucs, patience)
    assert boosting.best_round([None, None], 20) == (2, True) and boosting.best_round([], 20) == (0, True)


def test_boosting_keeps_the_best_round(matrix):
    train, held = matrix.where("NOT held"), matrix.where("held")
    model = boosting.boost(train, held, booster(60), "y", patience=5)
    aucs = boosting.staged_auc(booster(60).fit(train), held, "y")
    assert model.getNumTrees == brute_best(aucs, 5)[0] < 60


def test_one_class_keeps_all_rounds(matrix):
    train, held = matrix.where("NOT held"), matrix.where("held AND y = 1")
    assert boosting.boost(train, held, booster(6, 2), "y", patience=2).getNumTrees == 4
    assert boosting.staged_auc(booster(2, 2).fit(train), held.limit(0), "y") == [None, None]
    assert boosting.staged_auc(booster(2, 2).fit(train), held.withColumn("y", F.lit(None).cast("int")), "y") == [None, None]


def test_all_rounds_are_fitted_once(matrix, monkeypatch):
    fitted = []

    def rising(model, held_out, label):
        fitted.append(model.getNumTrees)
        return [k / 100 for k in range(model.getNumTrees)]

    monkeypatch.setattr(boosting, "staged_auc", rising)
    assert boosting.boost(matrix, matrix, booster(12, 1), "y", patience=1).getNumTrees == 12
    assert fitted == [2, 12]
