"""Boosted trees that stop when the AUC of a held-out slice has not risen for some rounds.

MLlib judges rounds by loss. So a booster is grown for a few rounds, the AUC of each
of its prefixes is measured in one pass over the held-out rows, and only if the
patience is not used up it goes on to all rounds. What is kept is always judged by its
own figures.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .histograms import Grower

LEAVES = "_leaves"
BINS = 1 << 16  # of the probability: scores that share one count as tied
TREE, LEAF = re.compile(r"^\s*Tree (\d+) \(weight ([^)]+)\):$"), re.compile(r"^\s*Predict: (\S+)$")


def leaf_values(model: GBTClassificationModel) -> np.ndarray:
    """What each leaf adds to the margin: a row per tree, leaves from left to right, padded with zeros."""
    trees: list[list[float]] = []
    weight = 0.0
    for line in model.toDebugString.splitlines():
        if found := TREE.match(line):
            weight = float(found[2])
            trees.append([])
        elif found := LEAF.match(line):
            trees[-1].append(weight * float(found[1]))
    table = np.zeros((len(trees), max(map(len, trees), default=0)))
    for row, values in zip(table, trees, strict=True):
        row[: len(values)] = values
    return table


def staged_auc(model: GBTClassificationModel, held_out: DataFrame, label: str) -> list[float | None]:
    """AUC of every prefix of the ensemble, shortest first; None where a class is absent.

    Each row is walked through the trees once. Rows are counted by round, bin of
    the probability and class inside the tasks, so what is shuffled is bounded by
    rounds and bins.
    """
    values = leaf_values(model)
    rounds = len(values)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            leaves = np.array(batch.column(0).flatten().to_numpy(zero_copy_only=False)).reshape(batch.num_rows, rounds).astype(np.int64)
            margins = np.cumsum(values[np.arange(rounds), leaves], axis=1)
            bins = np.minimum((BINS / (1 + np.exp(-2 * margins))).astype(np.int64), BINS - 1)
            positive = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            key, counts = np.unique(((np.arange(rounds) * BINS + bins) * 2 + positive[:, None]).ravel(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(counts.astype(np.int64))], names=["key", "c"])

    walked = model.copy().setLeafCol(LEAVES).transform(held_out.where(F.col(label).isNotNull()))
    rows = walked.select(vector_to_array(LEAVES).alias("leaves"), (F.col(label) == 1).cast("long").alias("positive"))
    rows = rows.mapInArrow(count, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))
    c, side = F.col("c"), F.col("key") % 2
    by_bin = rows.groupBy(F.expr(f"key div {2 * BINS}").alias("round"), F.expr("key div 2").alias("bin")).agg(
        F.sum(F.when(side == 1, c).otherwise(0)).alias("pos"), F.sum(F.when(side == 0, c).otherwise(0)).alias("neg")
    )
    below = F.sum("neg").over(W.partitionBy("round").orderBy("bin")) - F.col("neg") / 2
    wins = by_bin.withColumn("wins", F.col("pos") * below).groupBy("round")
    found = wins.agg(F.try_divide(F.sum("wins"), F.sum("pos").cast("double") * F.sum("neg")).alias("auc")).collect()
    aucs = {r["round"]: r["auc"] for r in found}
    return [aucs.get(k) for k in range(rounds)]


def best_round(aucs: list[float | None], patience: int) -> tuple[int, bool]:
    """Number of rounds to keep, and whether ``patience`` rounds after it brought nothing better.

    The first of equal rounds wins. Without any AUC all rounds stay, and waiting is of no use.
    """
    best, kept = None, 0
    for k, auc in enumerate(aucs, 1):
        if auc is not None and (best is None or auc > best):
            best, kept = auc, k
        elif best is not None and k - kept >= patience:
            return kept, True
    return (kept, False) if best is not None else (len(aucs), True)


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The ensemble cut after ``rounds`` trees, with the same settings."""
    java, jvm = model._java_obj, SparkContext.getOrCreate()._jvm
    trees, weights = java.trees()[:rounds], java.treeWeights()[:rounds]  # copies on the Java side
    cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        java.uid(), trees, weights, java.numFeatures(), java.numClasses()
    )
    return model._copyValues(GBTClassificationModel(cut))


def boost(train: DataFrame, held_out: DataFrame, booster: GBTClassifier, label: str, patience: int) -> GBTClassificationModel:
    """Fit up to ``maxIter`` rounds and keep those up to the best AUC on ``held_out``."""
    most = booster.getMaxIter()
    rounds = min(most, 2 * patience)
    grower = Grower(train, booster)
    try:
        while True:
            model = grower.grow(rounds)
            aucs = staged_auc(model, held_out, label)
            kept, done = best_round(aucs, patience)
            if done or rounds >= most:
                return first_rounds(model, kept) if kept < len(aucs) else model
            rounds = most
    finally:
        grower.close()
