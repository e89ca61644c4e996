"""Boosted trees from histograms of binned rows, as MLlib's ``GBTClassifier`` grows them.

MLlib walks every row through the tree and adds it to the statistics of its node
object by object. Here the rows lie on their executors' local disks as one byte per
feature (two where one has more than 256 bins), a job per level counts them with array
operations, and the driver adds up the histograms. Candidate splits, gains, ties of the
first tree, leaf rules and pruning are MLlib's; later trees are the same up to the order
in which fractions are added. The result is MLlib's own model.

Only the smaller child of a split is counted, the other is what remains of the parent
(but in the first tree, which MLlib's rounding decides). What a task sends is bounded
by nodes, features and bins, not by rows.

Files are a cache: what they hold follows from the rows and the trees, and a task that
finds none on its machine says so and gets them made anew.
"""

from __future__ import annotations

import math
import os
import shutil
import sys
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.serializers import CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Executors don't need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FROM_ROWS = 300_000  # fewer rows are MLlib's: its jobs are shorter than those of Python workers
BLOCK = 32_768  # rows counted at once, so that they stay in the processor's cache
GROUP = 64  # nodes whose histograms are collected at once
TRIES = 5  # to make lost files anew
SAMPLE = 10_000  # MLlib's number of rows for candidate splits, at least
EPSILON = 2.0**-52
NOISE = 1e-12  # of a node's mean square: gains that differ by less are equal, below it there is none
# What :func:`grow` leaves to MLlib when it is set otherwise.
PLAIN = {"subsamplingRate": 1.0, "featureSubsetStrategy": "all", "minWeightFractionPerNode": 0.0, "minInfoGain": 0.0, "lossType": "logistic"}


@dataclass
class Tree:
    """Nodes in the order they were found; a leaf has the feature -1 and no children."""

    feature: list[int] = field(default_factory=list)
    goes_left: list = field(default_factory=list)  # of each bin; None at a leaf
    children: list = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    stats: list = field(default_factory=list)  # rows, sum of weights, of weighted labels, of their squares

    def add(self, stats) -> int:
        self.feature.append(-1)
        self.goes_left.append(None)
        self.children.append(None)
        self.gain.append(0.0)
        self.stats.append(tuple(stats))
        return len(self.feature) - 1

    def prediction(self, node: int) -> float:
        _, weight, total, _ = self.stats[node]
        return total / weight if weight else 0.0

    def impurity(self, node: int) -> float:
        _, weight, total, squares = self.stats[node]
        return (squares - total * total / weight) / weight if weight else 0.0

    def routes(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The feature each node asks for, and by node and bin where a row goes; leaves keep their rows."""
        to = np.repeat(np.arange(len(self.feature)), width).reshape(-1, width)
        for node, pair in enumerate(self.children):
            if pair:
                left = self.goes_left[node]
                to[node, : len(left)] = np.where(left, *pair)
        return np.maximum(self.feature, 0), to.ravel().astype(np.int32)

    def finished(self, plan: Plan, rate: float) -> tuple:
        """What adds the tree to the margins."""
        return self.routes(plan.width), self.depth(), np.array([self.prediction(n) for n in range(len(self.feature))]), rate

    def depth(self, node: int = 0) -> int:
        return 1 + max(map(self.depth, self.children[node])) if self.children[node] else 0


@dataclass
class Plan:
    """What the tasks have to know."""

    bins: list[int]  # of each feature
    thresholds: list  # None for a category
    weights: tuple[float, float]  # of a row with label 0 and 1
    depth: int
    rate: float
    least: int  # rows of a child

    @property
    def width(self) -> int:
        return max(self.bins, default=1)

    def used(self, nodes: int) -> np.ndarray:
        """Which cells of a histogram by feature, node and bin stand for a bin."""
        return (np.arange(self.width) < np.array(self.bins)[:, None])[:, None].repeat(nodes, axis=1).reshape(len(self.bins), -1)


def encode(plan: Plan):
    """Labels and features as bins, one row per batch; the bins lie feature by feature."""
    kind = np.uint8 if plan.width <= 256 else np.uint16 if plan.width <= 65536 else np.uint32

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            positive = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            if not np.isfinite(values).all():
                raise ValueError("features must be finite numbers")
            codes = np.empty(values.shape[::-1], kind)
            for k, (limits, bins) in enumerate(zip(plan.thresholds, plan.bins, strict=True)):
                if limits is None:
                    number = values[:, k].astype(np.int64)
                    if ((number != values[:, k]) | (number < 0) | (number >= bins)).any():
                        raise ValueError(f"feature {k} has values that are none of its {bins} categories")
                    codes[k] = number
                else:
                    codes[k] = np.searchsorted(limits, values[:, k], side="left")
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (positive, codes)], names=["positive", "codes"])

    return run, kind


class Store:
    """The files of a partition: its labels and bins, margins before a tree, and nodes after a level of one."""

    def __init__(self, name: str):
        self.folder = os.path.join(tempfile.gettempdir(), f"lendscape-{name}", str(TaskContext.get().partitionId()))

    def get(self, name: str) -> np.ndarray | None:
        try:
            return np.load(f"{self.folder}/{name}.npy", mmap_mode="r")
        except (FileNotFoundError, ValueError):  # a file without rows can't be mapped
            return np.load(f"{self.folder}/{name}.npy") if os.path.exists(f"{self.folder}/{name}.npy") else None

    def put(self, name: str, values: np.ndarray) -> None:
        """Whole or not at all: an attempt may be running twice, and both write the same."""
        os.makedirs(self.folder, exist_ok=True)
        own = f"{self.folder}/{uuid.uuid4().hex}"
        with open(own, "wb") as f:
            np.save(f, values)
        os.replace(own, f"{self.folder}/{name}.npy")

    def drop(self, *names: str) -> None:
        for name in names:
            try:
                os.remove(f"{self.folder}/{name}.npy")
            except FileNotFoundError:
                pass


def load(name: str, features: int, kind):
    """Rows of :func:`encode` into files; the number of rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        positive, codes = [np.zeros(0, bool)], [np.zeros((features, 0), kind)]
        for batch in batches:
            for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                positive.append(np.frombuffer(p, bool))
                codes.append(np.frombuffer(c, kind).reshape(features, -1))
        store = Store(name)
        store.put("codes", np.concatenate(codes, axis=1))
        store.put("positive", np.concatenate(positive))
        yield pa.RecordBatch.from_arrays([pa.array([sum(map(len, positive))])], names=["n"])

    return run


def _variance(weight, total, squares):
    return (squares - total * total / weight) / weight


def best_splits(plan: Plan, counts: np.ndarray, sums: np.ndarray, stats: np.ndarray, first: bool):
    """Feature, gain, bins that go left and statistics of both children for each node; feature -1 without a valid split.

    ``counts`` are by class, node, feature and bin, ``sums`` by node, feature and
    bin, ``stats`` by node. In the first tree ``counts`` are rows and their weights.
    There labels are 1 and -1 and many splits are equally good: sums are added and
    compared just as in MLlib, whose rounding decides between them, and the
    children's statistics are taken from them. In later trees the first of equal
    gains wins. Sums run in order, so every task comes to the same result.
    """
    rows, weights = counts if first else (counts.sum(axis=0), plan.weights[0] * counts[0] + plan.weights[1] * counts[1])
    order = np.broadcast_to(np.arange(plan.width), rows.shape).copy()
    with np.errstate(invalid="ignore", divide="ignore"):
        for k, limits in enumerate(plan.thresholds):
            if limits is None:  # categories in the order of their means, absent ones last
                mean = np.where(rows[:, k] > 0, sums[:, k] / weights[:, k], np.inf)
                order[:, k] = np.argsort(mean, axis=1, kind="stable")
        n, w, s = (np.cumsum(np.take_along_axis(x, order, axis=2), axis=2) for x in (rows, weights, sums))
        rest_n, rest_w, rest_s = (x[:, :, -1:] - x for x in (n, w, s))
        valid = (n >= plan.least) & (rest_n >= plan.least)
        if first:
            all_w = w + rest_w
            impurity = _variance(*stats[:, 1:].T)[:, None, None]
            gain = impurity - w / all_w * _variance(w, s, w) - rest_w / all_w * _variance(rest_w, rest_s, rest_w)
            noise = np.zeros(len(stats))
        else:
            mean, mean_square = stats[:, 2] / stats[:, 1], stats[:, 3] / stats[:, 1]
            gain = (s * s / w + rest_s * rest_s / rest_w) / (w + rest_w) - (mean * mean)[:, None, None]
            noise = NOISE * mean_square
    flat = np.where(valid, gain, -np.inf).reshape(len(gain), -1)
    at = (flat >= (flat.max(axis=1) - noise)[:, None]).argmax(axis=1)
    found = []
    for node, place in enumerate(at):
        feature, last = divmod(int(place), plan.width)
        if not flat[node, place] > noise[node]:
            found.append((-1, 0.0, None, None))
            continue
        left = np.zeros(plan.bins[feature], bool)
        chosen = order[node, feature, : last + 1]
        left[chosen[chosen < plan.bins[feature]]] = True
        sides = [[x[node, feature, last] for x in parts] for parts in ((n, w, s, w), (rest_n, rest_w, rest_s, rest_w))]
        found.append((feature, float(flat[node, place]), left, sides))
    return found


@dataclass
class Level:
    """What the tasks do for one level: bring their rows there and count them."""

    number: int  # of the tree
    depth: int
    routes: tuple | None  # of the tree so far
    first: int  # of the nodes whose statistics are wanted
    nodes: int
    counted: list[int]
    before: tuple | None  # routes, depth and leaf values of the tree before


class Rows:
    """The rows of a task with their margins."""

    def __init__(self, plan: Plan, store: Store):
        self.plan, self.store = plan, store
        self.codes, self.positive = store.get("codes"), store.get("positive")

    def blocks(self) -> Iterator[slice]:
        return (slice(at, min(at + BLOCK, len(self.positive))) for at in range(0, len(self.positive), BLOCK))

    def weights(self, block: slice) -> np.ndarray:
        return np.where(self.positive[block], self.plan.weights[1], self.plan.weights[0])

    def step(self, node: np.ndarray, routes, times: int = 1) -> np.ndarray:
        """Nodes after the next levels."""
        asked, to = routes
        asked, codes, after = asked * len(self.positive), self.codes.reshape(-1), np.empty_like(node)
        for block in self.blocks():
            row, at = np.arange(block.start, block.stop), node[block].astype(np.int64)
            for _ in range(times):
                at = to[at * self.plan.width + codes[asked[at] + row]]
            after[block] = at
        return after

    def nodes(self, level: Level) -> np.ndarray:
        now = np.zeros(len(self.positive), np.int32)
        if not level.depth:
            return now
        known = self.store.get(f"node-{level.number}-{level.depth - 1}")
        now = self.step(now, level.routes, level.depth) if known is None else self.step(known, level.routes)
        self.store.put(f"node-{level.number}-{level.depth}", now)
        self.store.drop(f"node-{level.number}-{level.depth - 1}")
        return now

    def margins(self, number: int, before) -> np.ndarray | None:
        """Margins before a tree, from those before the last one; None where these are lost."""
        if not number:
            return np.zeros(len(self.positive))
        known = self.store.get(f"margin-{number}")
        if known is not None:
            return known
        old = self.margins(0, None) if number == 1 else self.store.get(f"margin-{number - 1}")
        if old is None:
            return None
        routes, depth, values, rate = before
        node = self.store.get(f"node-{number - 1}-{depth}")
        if node is None:
            node = self.step(np.zeros(len(self.positive), np.int32), routes, depth)
        new = old + rate * values[node]
        self.store.put(f"margin-{number}", new)
        self.store.drop(f"margin-{number - 1}", f"node-{number - 1}-{depth}")
        return new

    def count(self, level: Level) -> list[np.ndarray] | None:
        """Statistics by node, and histograms by feature, node and bin; None where files are lost."""
        if self.codes is None or self.positive is None:
            return None
        margins = self.margins(level.number, level.before)
        if margins is None:
            return None
        node, features, first = self.nodes(level), len(self.codes), not level.number
        slot_of = np.full(level.first + level.nodes, -1)
        slot_of[level.counted] = np.arange(len(level.counted))
        cells = len(level.counted) * self.plan.width
        stats, sums = np.zeros((level.nodes, 4)), np.zeros((features, cells))
        counts = np.zeros((2, features, cells), float if first else np.int64)
        for block in self.blocks():
            positive, weight, at = self.positive[block], self.weights(block), node[block]
            y = np.where(positive, 1.0, -1.0)
            label = weight * (y if first else 4 * y / (1 + np.exp(2 * y * margins[block])))
            self._add_stats(stats, at - level.first, weight, label)
            if not level.counted:
                continue
            slot, codes = slot_of[at], self.codes[:, block]
            if level.depth:
                chosen = np.flatnonzero(slot >= 0)
                slot, label, codes, positive, weight = slot[chosen], label[chosen], codes[:, chosen], positive[chosen], weight[chosen]
            if not len(slot):
                continue
            for k in range(features):
                if first:  # each row is added to what came before it, as MLlib adds them in a partition
                    place = slot * self.plan.width + codes[k]
                    counts[0, k] += np.bincount(place, minlength=cells)
                    np.add.at(counts[1, k], place, weight)
                    np.add.at(sums[k], place, label)
                    continue
                if not k:
                    base, place = slot * self.plan.width + positive * cells, np.empty(len(slot), np.int64)
                np.add(base, codes[k], out=place)
                counts[:, k] += np.bincount(place, minlength=2 * cells).reshape(2, cells)
                sums[k] += np.bincount(place, weights=label, minlength=2 * cells).reshape(2, cells).sum(axis=0)
        used = self.plan.used(len(level.counted))
        return [stats, *(c[used] if first else c[used].astype(np.uint32) for c in counts), sums[used]]

    @staticmethod
    def _add_stats(stats: np.ndarray, node: np.ndarray, weight: np.ndarray, label: np.ndarray) -> None:
        new = node >= 0
        if not new.all():
            node, weight, label = node[new], weight[new], label[new]
        for n, x in enumerate((None, weight, label, label * label / weight)):
            stats[:, n] += np.bincount(node, weights=x, minlength=len(stats))


def counter(plan: Plan, name: str, level: Level):
    def run(rows: Iterable) -> Iterator:
        list(rows)  # a worker that leaves some unread is not used again
        yield Rows(plan, Store(name)).count(level)

    return run


def replay(plan: Plan, name: str, trees: list[tuple]):
    """Margins after all ``trees``, where they are missing."""

    def run(rows: Iterable) -> Iterator:
        list(rows)
        own = Rows(plan, Store(name))
        if own.codes is not None and own.positive is not None and trees and own.store.get(f"margin-{len(trees)}") is None:
            total = np.zeros(len(own.positive))
            for routes, depth, values, rate in trees:
                total += rate * values[own.step(np.zeros(len(total), np.int32), routes, depth)]
            own.store.put(f"margin-{len(trees)}", total)
        yield own.codes is not None and own.positive is not None

    return run


def clear(name: str):
    def run(rows: Iterable) -> Iterator:
        list(rows)
        shutil.rmtree(os.path.dirname(Store(name).folder), ignore_errors=True)
        yield True

    return run


def thresholds(values: np.ndarray, weights: np.ndarray, expected: float, splits: int) -> np.ndarray:
    """MLlib's candidate splits of a number: between sampled values, at even steps of the weight.

    ``expected`` is the weight a sample has on average: MLlib adds what is missing to the zeros.
    """
    present = values != 0
    found, place = np.unique(values[present], return_inverse=True)
    own = np.zeros(len(found))
    np.add.at(own, place, weights[present])
    if not len(found):
        return np.zeros(0)
    missing = expected - own.sum()
    if missing > EPSILON * present.sum() * 100:
        at = int(np.searchsorted(found, 0.0))
        found, own = np.insert(found, at, 0.0), np.insert(own, at, missing)
    middle = (found[:-1] + found[1:]) / 2
    if len(middle) <= splits:
        return middle
    stride = expected / (splits + 1)
    chosen, target, current = [], stride, own[0]
    for k in range(1, len(found)):
        before, current = current, current + own[k]
        if abs(before - target) < abs(current - target):
            chosen.append(middle[k - 1])
            target += stride
    return np.array(chosen)


def _root(plan: Plan, counts: np.ndarray, sums: np.ndarray) -> tuple:
    """Both sides of the first split there is, as MLlib adds them up."""
    k = next((k for k, bins in enumerate(plan.bins) if bins > 1), 0)
    n, w, s = (np.cumsum(x[0, k]) for x in (*counts, sums))
    n, w, s = (x[0] + (x[-1] - x[0]) for x in (n, w, s))
    return n, w, s, w


def _children(counts, sums, small, less, less_sums):
    """Histograms of both children of each split, from the smaller one's and the parent's."""
    rest = counts - less
    rest_sums = np.where(rest.sum(axis=0) > 0, sums - less_sums, 0.0)
    right = np.array(small, bool)
    both = np.empty((2, 2 * len(small), *counts.shape[2:]), np.int64)
    both_sums = np.empty((2 * len(small), *sums.shape[1:]))
    for side in (0, 1):
        own = right == bool(side)
        both[:, side::2] = np.where(own[None, :, None, None], less, rest)
        both_sums[side::2] = np.where(own[:, None, None], less_sums, rest_sums)
    return both, both_sums


class Grower:
    """Rounds of one booster on one training set; further rounds follow those there are."""

    def __init__(self, train: DataFrame, booster: GBTClassifier):
        self.train, self.booster, self.spark = train, booster, train.sparkSession
        self.trees: list[Tree] = []
        self.java_trees: list = []
        self.rows_held: DataFrame | None = None
        self.name = uuid.uuid4().hex
        self.plan = self._plan() if self._plain() else None

    def _plain(self) -> bool:
        b = self.booster
        if any(b.getOrDefault(name) != value for name, value in PLAIN.items()):
            return False
        return not b.isDefined(b.validationIndicatorCol)

    def _plan(self) -> Plan | None:
        """What MLlib would find out about the rows; None where it should see to them itself."""
        b = self.booster
        label, weight = F.col(b.getLabelCol()), F.col(b.getWeightCol()) if b.isDefined(b.weightCol) and b.getWeightCol() else F.lit(1.0)
        rows = self.train.groupBy(label.cast("double").alias("y")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(weight.cast("double")).alias("sum"), F.min(weight).alias("least"), F.max(weight).alias("most")
        ).collect()
        facts = {r["y"]: r for r in rows}
        if not facts or not set(facts) <= {0.0, 1.0} or any(r["least"] is None or r["least"] != r["most"] or not r["least"] > 0 for r in rows):
            return None
        self.rows, self.weight = sum(r["n"] for r in rows), sum(r["sum"] for r in rows)
        if self.rows < FROM_ROWS:
            return None
        jvm = self.spark.sparkContext._jvm
        schema = self.train._jdf.schema()
        categories = dict(jvm.scala.jdk.javaapi.CollectionConverters.asJava(
            jvm.org.apache.spark.ml.util.MetadataUtils.getCategoricalFeatures(schema.apply(b.getFeaturesCol()))
        ))
        most = min(b.getMaxBins(), self.rows)
        sample, share = self._sample(label, weight, most)
        features = len(sample[0]["x"]) if sample else 0
        if not features or any(n > most for n in categories.values()):
            return None
        values, weights = np.array([r["x"] for r in sample]), np.array([r["w"] for r in sample])
        limits = [None if k in categories else thresholds(values[:, k], weights, share * self.weight, most - 1) for k in range(features)]
        return Plan(
            bins=[categories[k] if x is None else len(x) + 1 for k, x in enumerate(limits)],
            thresholds=limits,
            weights=tuple(facts[y]["least"] if y in facts else 1.0 for y in (0.0, 1.0)),
            depth=b.getMaxDepth(),
            rate=b.getStepSize(),
            least=b.getMinInstancesPerNode(),
        )

    def _sample(self, label, weight, bins: int) -> tuple[list, float]:
        """The very rows MLlib draws, and their share: its sample goes by partition and place alone."""
        sc, wanted = self.spark.sparkContext, max(bins * bins, SAMPLE)
        chosen = self.train.select(vector_to_array(self.booster.getFeaturesCol()).alias("x"), weight.cast("double").alias("w"))
        if wanted >= self.rows:
            return chosen.collect(), 1.0
        share = wanted / self.rows
        seed = sc._jvm.org.apache.spark.util.random.XORShiftRandom(self.booster.getSeed()).nextInt()
        drawn = chosen._jdf.javaRDD().sample(False, share, seed)
        frame = self.spark._jsparkSession.createDataFrame(drawn, chosen._jdf.schema())
        return DataFrame(frame, self.spark).collect(), share

    def _hold(self) -> None:
        """Bin the rows into files. Each task leaves one cached row, which draws later tasks to its machine.

        Rows stay in their partitions where there is a core for each: then the first tree adds them up in MLlib's order.
        """
        run, kind = encode(self.plan)
        label = (F.col(self.booster.getLabelCol()) == 1).alias("positive")
        rows = self.train.select(label, vector_to_array(self.booster.getFeaturesCol()).alias("x"))
        rows = rows.mapInArrow(run, "positive binary, codes binary")
        cores = self.spark.sparkContext.defaultParallelism
        if self.train._jdf.rdd().getNumPartitions() > cores:
            rows = rows.repartition(cores)
        self.rows_held = rows.mapInArrow(load(self.name, len(self.plan.bins), kind), "n long").persist(StorageLevel.MEMORY_AND_DISK)
        self.held = self.rows_held.rdd

    def _counted(self, level: Level):
        """Sums over all tasks, in their order; counts and sums by node, feature and bin."""
        for _ in range(TRIES):
            parts = self.held.mapPartitions(counter(self.plan, self.name, level)).collect()
            if all(p is not None for p in parts):
                break
            done = [t.finished(self.plan, self._rate(k)) for k, t in enumerate(self.trees)]
            if not all(self.held.mapPartitions(replay(self.plan, self.name, done)).collect()):
                self.rows_held.unpersist(blocking=True)
                self._hold()
                self.held.mapPartitions(replay(self.plan, self.name, done)).collect()
        else:
            raise RuntimeError("files of binned rows were lost again and again")
        stats, *totals = (sum(x[1:], start=x[0].astype(np.int64) if x[0].dtype == np.uint32 else x[0]) for x in zip(*parts, strict=True))
        group, used = len(level.counted), self.plan.used(len(level.counted))
        cells = np.zeros((3, *used.shape)) if not level.number else [np.zeros(used.shape, x.dtype) for x in totals]
        for x, total in zip(cells, totals, strict=True):
            x[used] = total
        a, b, s = (x.reshape(len(x), group, self.plan.width).swapaxes(0, 1) for x in cells)
        return stats, np.stack([a, b]), s

    def _rate(self, number: int) -> float:
        return self.plan.rate if number else 1.0

    def _tree(self) -> Tree:
        plan, number, tree = self.plan, len(self.trees), Tree()
        before = self.trees[-1].finished(plan, self._rate(number - 1)) if number else None
        stats, counts, sums = self._counted(Level(number, 0, None, 0, 1, [0], before))
        tree.add(_root(plan, counts, sums) if not number else stats[0])
        open_nodes = [0]
        for depth in range(1, plan.depth + 1):
            found = best_splits(plan, counts, sums, np.array([tree.stats[n] for n in open_nodes]), not number) if open_nodes else []
            split, first, small = [], len(tree.feature), []
            for at, (node, (feature, gain, left, sides)) in enumerate(zip(open_nodes, found, strict=True)):
                if feature < 0:
                    continue
                tree.feature[node], tree.gain[node], tree.goes_left[node] = feature, gain, left
                tree.children[node] = tuple(map(tree.add, sides))
                split.append(at)
                small.append(int(sides[0][0] > sides[1][0]))  # 1: the right child
            if not split:
                break
            new, last = list(range(first, len(tree.feature))), depth == plan.depth
            counted = [first + 2 * i + side for i, side in enumerate(small)] if number else new
            groups = [[]] if last else [counted[i : i + GROUP] for i in range(0, len(counted), GROUP)]
            parts = []
            if number or not last:
                routes = tree.routes(plan.width)
                parts = [self._counted(Level(number, depth, routes, first, len(new), group, before)) for group in groups]
            if number:
                tree.stats[first:] = [tuple(x) for x in parts[0][0]]
            if last:
                break
            less, less_sums = np.concatenate([p[1] for p in parts], axis=1), np.concatenate([p[2] for p in parts])
            counts, sums = _children(counts[:, split], sums[split], small, less, less_sums) if number else (less, less_sums)
            still = [i for i, n in enumerate(new) if abs(tree.impurity(n)) >= EPSILON]
            counts, sums, open_nodes = counts[:, still], sums[still], [new[i] for i in still]
        return tree

    def grow(self, rounds: int) -> GBTClassificationModel:
        """The model of ``rounds`` rounds; those grown before stay."""
        if self.plan is None:
            return self.booster.copy({self.booster.maxIter: rounds}).fit(self.train)
        if self.rows_held is None:
            self._hold()
        while len(self.trees) < rounds:
            self.trees.append(self._tree())
        return self._model()

    def close(self) -> None:
        if self.rows_held is not None:
            self.held.mapPartitions(clear(self.name)).collect()
            self.rows_held.unpersist()

    def _model(self) -> GBTClassificationModel:
        sc, b = self.spark.sparkContext, self.booster
        ml, features = sc._jvm.org.apache.spark.ml, len(self.plan.bins)
        for tree in self.trees[len(self.java_trees) :]:
            root = self._java_nodes(tree)
            self.java_trees.append(ml.regression.DecisionTreeRegressionModel(ml.util.Identifiable.randomUID("dtr"), root, features))
        kind = ml.regression.DecisionTreeRegressionModel
        trees = sc._gateway.new_array(kind, len(self.java_trees))
        weights = sc._gateway.new_array(sc._jvm.double, len(self.java_trees))
        for k, tree in enumerate(self.java_trees):
            trees[k], weights[k] = tree, self._rate(k)
        model = GBTClassificationModel(ml.classification.GBTClassificationModel(b.uid, trees, weights, features, 2))
        model._resetUid(b.uid)
        return b._copyValues(model)

    def _java_nodes(self, tree: Tree):
        """MLlib's nodes, children first; two leaves that say the same become one."""
        jvm, plan = self.spark.sparkContext._jvm, self.plan
        lefts = [sorted(np.flatnonzero(x).astype(float)) if x is not None and plan.thresholds[f] is None else [] for f, x in zip(tree.feature, tree.goes_left)]
        arrays = jvm.org.apache.spark.ml.python.MLSerDe.loads(
            CPickleSerializer().dumps([_doubles(x) for x in [*(s[1:] for s in tree.stats), *lefts]])
        )
        size, built, leaf = len(tree.feature), {}, {}
        nodes = jvm.org.apache.spark.ml.tree
        for k in range(size - 1, -1, -1):
            stats = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(arrays[k], int(tree.stats[k][0]))
            said, impurity, pair = tree.prediction(k), tree.impurity(k), tree.children[k]
            leaf[k] = not pair or (leaf[pair[0]] and leaf[pair[1]] and tree.prediction(pair[0]) == tree.prediction(pair[1]))
            if leaf[k]:
                built[k] = nodes.LeafNode(said, impurity, stats)
                continue
            feature = tree.feature[k]
            if plan.thresholds[feature] is None:
                split = nodes.CategoricalSplit(feature, arrays[size + k], plan.bins[feature])
            else:
                split = nodes.ContinuousSplit(feature, float(plan.thresholds[feature][int(tree.goes_left[k].sum()) - 1]))
            built[k] = nodes.InternalNode(said, impurity, float(tree.gain[k]), built[pair[0]], built[pair[1]], split, stats)
        return built[0]


def _doubles(values):
    from array import array

    return array("d", values)
