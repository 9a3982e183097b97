"""Boosted trees grown from histograms of binned rows, as models of Spark ML.

The trees of Spark ML's ``GBTRegressor`` with squared loss (level by level, largest
drop of variance, residuals of the rounds before as labels), for tables of many rows
and features, where Spark ML's learner spends most of its time on objects per row,
feature and level.  Rows are binned once and dealt, packed in blocks, over the tasks of
one barrier stage.  A task keeps its share in temporary files of its own (a byte per
feature, 12 for label and node), mapped into memory.  Per level it adds up counts and
labels per node, feature and bin with numpy; only these sums, bounded by the model, go
round, and every task chooses the same splits from their total.
"""

from __future__ import annotations

import base64
import tempfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from featflow.session import ship_package

# Bytes of the sums that a task sends per level.
_SUM_BYTES = 4 << 20
# Tasks of a fit: all of them get the sums of all.
_MOST_TASKS = 128
_BLOCK = "rows int, bins binary, labels binary"


class Grown:
    """A tree over bins: arrays in the order of growth; a leaf is its own child."""

    def __init__(self, total: np.ndarray):
        self.feature, self.cut, self.left = [0], [np.iinfo(np.int32).max], [0]
        #: (rows, sum) of the labels per node; gain per split.
        self.total, self.gain = [total], [0.0]

    def split(self, node: int, feature: int, cut: int, gain: float,
              left: np.ndarray, right: np.ndarray) -> tuple[int, int]:
        at = len(self.total)
        self.feature[node], self.cut[node], self.left[node], self.gain[node] = feature, cut, at, gain
        for i, total in enumerate((left, right)):
            self.feature.append(0)
            self.cut.append(np.iinfo(np.int32).max)
            self.left.append(at + i)
            self.gain.append(0.0)
            self.total.append(total)
        return at, at + 1

    def inner(self, node: int) -> bool:
        return self.left[node] != node

    def added_up(self, of_leaves: np.ndarray) -> np.ndarray:
        """Sums per leaf added up per node (children come after their parents)."""
        sums = of_leaves.copy()
        for i in reversed(range(len(sums))):
            if self.inner(i):
                sums[i] = sums[self.left[i]] + sums[self.left[i] + 1]
        return sums

    def value(self, node: int) -> float:
        return float(self.total[node][1] / self.total[node][0])

    def next_nodes(self, bins: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The nodes one level below ``at`` for rows of (feature, row) bins; leaves stay."""
        n = bins.shape[1]
        start, cut = np.array(self.feature, np.int64) * n, np.array(self.cut, np.int32)
        found = bins.ravel().take(start.take(at) + np.arange(n))
        return np.array(self.left, np.int64).take(at) + (found > cut.take(at))


class Share:
    """A task's rows: bins, what is left of the labels and nodes, by block."""

    def __init__(self, blocks: Iterator[Row], width: int, kind):
        self.width, self.sizes = width, []
        bins, rest = tempfile.TemporaryFile(), tempfile.TemporaryFile()
        for block in blocks:
            bins.write(block["bins"])
            rest.write(block["labels"])
            self.sizes.append(block["rows"])
        bins.flush()
        rest.flush()
        n = sum(self.sizes)
        if n:
            self.bins = np.memmap(bins, kind, "r", shape=(n * width,))
            self.rest = np.memmap(rest, np.float64, "r+", shape=(n,))
            self.node = np.memmap(tempfile.TemporaryFile(), np.int32, "w+", shape=(n,))

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(bins by feature, rests, nodes) of each block."""
        start = 0
        for n in self.sizes:
            at = slice(start, start + n)
            yield (self.bins[start * self.width:(start + n) * self.width].reshape(self.width, n),
                   self.rest[at], self.node[at])
            start += n

    def sums(self, scale: float, tree: Grown | None, slot: np.ndarray, most: int) -> np.ndarray:
        """(node slot, feature, bin, 2): rows and their labels.

        Moves every row one level down first; rows of nodes in slot -1 don't count.
        """
        cells = (int(slot.max()) + 1) * most
        total = np.zeros((2, self.width, cells))
        for bins, rest, node in self.blocks():
            if tree is None:
                base, label = np.zeros(len(rest), np.int64), scale * rest
            else:
                node[:] = tree.next_nodes(bins, node)
                base = slot.take(node)
                at = np.nonzero(base >= 0)[0]
                base, label, bins = base.take(at) * most, scale * rest.take(at), [b.take(at) for b in bins]
            for f in range(self.width):
                cell = base + bins[f]
                total[0, f] += np.bincount(cell, minlength=cells)
                total[1, f] += np.bincount(cell, label, cells)
        return total.reshape(2, self.width, -1, most).transpose(2, 1, 3, 0)

    def subtract(self, tree: Grown, weight: float, scale: float) -> np.ndarray:
        """Take the tree's weighted predictions off; all rows go back to the root.
        Returns the sum of squared labels per leaf."""
        value = weight * np.array([tree.value(i) for i in range(len(tree.total))])
        squares = np.zeros(len(value))
        for bins, rest, node in self.blocks():
            leaf = tree.next_nodes(bins, node)
            label = scale * rest
            squares += np.bincount(leaf, label * label, len(value))
            rest -= value.take(leaf)
            node[:] = 0
        return squares


def grow(share: Share, add: Callable[[np.ndarray], np.ndarray], cuts: Sequence[Sequence[float]],
         depth: int, scale: float) -> Grown:
    """One tree over the rows of all tasks; ``add`` totals an array over the tasks."""
    most = max(map(len, cuts)) + 1
    root = add(share.sums(scale, None, np.zeros(1, np.int64), most))[0]
    tree, level = Grown(root[0].sum(axis=0)), {0: root}
    for d in range(depth):
        following, fewer = [], []
        for node, sums in level.items():
            best = _best(sums, tree.total[node], cuts)
            if best is not None:
                f, cut, gain = best
                left = sums[f, :cut + 1].sum(axis=0)
                right = tree.total[node] - left
                pair = tree.split(node, f, cut, gain, left, right)
                # Rows of the smaller child are added up, the other has the rest.
                small = int(right[0] < left[0])
                fewer.append(pair[small])
                following.append((pair[small], pair[1 - small], sums))
        if not following or d == depth - 1:
            break
        slot = np.full(len(tree.total), -1, np.int64)
        slot[fewer] = np.arange(len(fewer))
        level = {}
        for sums, (small, large, parent) in zip(add(share.sums(scale, tree, slot, most)), following):
            level[small], level[large] = sums, parent - sums
            level[large][level[large][..., 0] == 0] = 0  # but for rounding
        level = dict(sorted(level.items()))
    return tree


def _blocks(rows: DataFrame, names: Sequence[str], label: str,
            cuts: Sequence[Sequence[float]], kind) -> DataFrame:
    """Rows of block (number of rows, bins by feature, labels)."""
    at = [np.array(c, np.float64) for c in cuts]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            *xs, y = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            bins = np.stack([np.searchsorted(c, x, side="left").astype(kind) for c, x in zip(at, xs)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(y)], pa.int32()), pa.array([bins.tobytes()], pa.binary()),
                 pa.array([np.ascontiguousarray(y, np.float64).tobytes()], pa.binary())],
                ["rows", "bins", "labels"])

    return rows.select(*[F.col(f"`{c}`").cast("double") for c in [*names, label]]).mapInArrow(pack, _BLOCK)


def can_grow(spark: SparkSession, learner: GBTRegressor, cuts: Sequence[Sequence[float]]) -> bool:
    """Whether a level's sums stay small and the session has barrier stages."""
    cells = len(cuts) * (max(map(len, cuts)) + 1)
    small = 16 * 2 ** max(0, learner.getMaxDepth() - 2) * cells <= _SUM_BYTES
    dynamic = spark.sparkContext.getConf().get("spark.dynamicAllocation.enabled", "false")
    return small and dynamic.lower() != "true"


def _tasks(spark: SparkSession) -> int:
    """Tasks that can run at the same time, as those of a barrier stage must."""
    context = spark.sparkContext._jsc.sc()
    slots = context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())
    return max(1, min(slots, _MOST_TASKS))


def fit_grown(rows: DataFrame, names: Sequence[str], label: str, cuts: Sequence[Sequence[float]],
              learner: GBTRegressor) -> GBTRegressionModel:
    """The learner's boosted trees over rows without nulls, split at the cuts only."""
    spark, most = rows.sparkSession, max(map(len, cuts)) + 1
    kind = np.uint8 if most <= 256 else np.uint16 if most <= 1 << 16 else np.int32
    rounds, depth, step = learner.getMaxIter(), learner.getMaxDepth(), learner.getStepSize()
    ship_package(spark)

    def trees(blocks: Iterator[Row]) -> Iterator[list[tuple[float, Grown]]]:
        context = BarrierTaskContext.get()

        def add(sums: np.ndarray) -> np.ndarray:
            texts = context.allGather(base64.b64encode(sums.tobytes()).decode())
            return sum(np.frombuffer(base64.b64decode(t)) for t in texts).reshape(sums.shape)

        share, grown, squares = Share(blocks, len(cuts), kind), [], []
        for k in range(rounds):
            # The first tree is fit on the labels, others on twice what is left of them.
            scale, weight = (2.0, step) if k else (1.0, 1.0)
            tree = grow(share, add, cuts, depth, scale)
            squares.append(share.subtract(tree, weight, scale))
            grown.append((weight, tree))
        every = np.split(add(np.concatenate(squares)), np.cumsum([len(q) for q in squares])[:-1])
        for (_, tree), of_leaves in zip(grown, every):
            tree.squares = tree.added_up(of_leaves)
        if not context.partitionId():
            yield grown

    blocks = _blocks(rows, names, label, cuts, kind).repartition(_tasks(spark))
    (grown,) = blocks.rdd.barrier().mapPartitions(trees).collect()
    return _model(spark, learner, grown, cuts)


def _best(sums: np.ndarray, total: np.ndarray, cuts: Sequence[Sequence[float]]
          ) -> tuple[int, int, float] | None:
    """(feature, cut, drop of variance) of the best split of a node; the first of equals."""
    left = sums[:, :-1].cumsum(axis=1)
    n, s = left[..., 0], left[..., 1]
    there = (n > 0) & (n < total[0])
    for f, c in enumerate(cuts):
        there[f, len(c):] = False
    if not there.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        both = s * s / n + (total[1] - s) ** 2 / (total[0] - n)
    gain = np.where(there, both - total[1] ** 2 / total[0], -np.inf)
    f, cut = np.unravel_index(int(gain.argmax()), gain.shape)
    if not gain[f, cut] > 1e-14 * both[f, cut]:  # no more than rounding leaves
        return None
    # Of splits that differ by rounding the first one, as if there were none.
    f, cut = np.unravel_index(int((gain >= gain[f, cut] - 1e-13 * both[f, cut]).argmax()), gain.shape)
    return int(f), int(cut), float(gain[f, cut] / total[0])


def _model(spark: SparkSession, learner: GBTRegressor, grown: Sequence[tuple[float, Grown]],
           cuts: Sequence[Sequence[float]]) -> GBTRegressionModel:
    """Spark ML's model of the trees (it has no call for it in Python)."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    ml, calculator = jvm.org.apache.spark.ml, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator

    def node(tree: Grown, i: int):
        (rows, total), squares = map(float, tree.total[i]), float(tree.squares[i])
        stats = gateway.new_array(jvm.double, 3)
        stats[0], stats[1], stats[2] = rows, total, squares
        variance = max(0.0, squares / rows - (total / rows) ** 2)
        kept = calculator(stats, int(rows))
        if not tree.inner(i):
            return ml.tree.LeafNode(tree.value(i), variance, kept)
        f, cut, left = tree.feature[i], tree.cut[i], tree.left[i]
        split = ml.tree.ContinuousSplit(f, float(cuts[f][cut]))
        return ml.tree.InternalNode(tree.value(i), variance, float(tree.gain[i]), node(tree, left),
                                    node(tree, left + 1), split, kept)

    trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(grown))
    weights = gateway.new_array(jvm.double, len(grown))
    for k, (weight, tree) in enumerate(grown):
        trees[k] = ml.regression.DecisionTreeRegressionModel(
            f"{learner.uid}_{k}", node(tree, 0), len(cuts))
        weights[k] = float(weight)
    made = ml.regression.GBTRegressionModel(learner.uid, trees, weights, len(cuts))
    model = learner._copyValues(GBTRegressionModel(made))
    model._transfer_params_to_java()
    return model
