"""Trees learnt from gradient histograms: leaf-wise boosting and forests.

Features are binned once (quantile edges from a mergeable sketch, or given
edges) and staged.  A node's histogram is one ``groupBy(node, feature, bin)``
with two sums, combined on the map side; its size is bounded by nodes x features
x bins, so only that reaches the driver, which finds the best splits.  A job
evaluates all nodes that could be split next: of each pair of children only the
left one is aggregated, the right one is the parent less the left.

Gradients are fixed-point numbers (``scale`` steps per unit of the label) and
bagging weights come from key hashes, so every sum is exact and a model does not
depend on partitioning, task order or repeated tasks.

* :func:`fit_boosted`: best-first growth to a number of leaves, squared loss;
* :func:`fit_forest`: Poisson(1) bagging by key hash, a feature subset per node
  by hash, growth to a depth; :func:`fit_tree` is one tree without either.

Models are column expressions: ``predict`` adds nested native conditions, no
Python on the row path, and ``ensemble`` hands the trees to the SHAP walk.

Rows with a null or NaN feature or label take no part in fitting; a row with a
null or NaN feature has a null prediction.  A column of one value has no split.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featflow.operators.models import hash_fraction
from featflow.operators.treeshap import Ensemble, Tree
from featflow.session import delete_path, fresh_path, spread

#: P(Poisson(1) <= k) for k = 0 ... 9.
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(10)]).tolist()


@dataclass
class Node:
    """A node of a binned tree: ``x <= threshold`` (``bin <= cut``) goes left."""
    weight: int
    grad: int
    heap: int = 1  # root 1, children 2i and 2i + 1
    label: int = 0  # order among leaves: the left child keeps it, the right gets a new one
    feature: int = -1
    cut: int = -1
    threshold: float = 0.0
    gain: float = 0.0
    value: float = 0.0
    left: Node | None = None
    right: Node | None = None
    split: bool = False
    hist: np.ndarray | None = field(default=None, repr=False)

    @property
    def depth(self) -> int:
        return self.heap.bit_length() - 1


@dataclass
class HistModel:
    """Trees over named features; prediction = base + sum of weight x tree."""
    features: list[str]
    base: float
    trees: list[Node]
    weights: list[float]

    def expression(self) -> Column:
        """The prediction as a native column expression."""
        total = F.lit(self.base)
        for tree, weight in zip(self.trees, self.weights):
            total = total + F.lit(weight) * _value(
                tree, lambda n: F.col(f"`{self.features[n.feature]}`") <= F.lit(n.threshold))
        return total

    def predict(self, df: DataFrame, column: str = "prediction") -> DataFrame:
        return df.withColumn(column, F.when(_valid(self.features), self.expression()))

    def pipeline(self) -> PipelineModel:
        """The model as a pipeline of one SQL stage, to save, load and score like
        any other (``save_model``, ``load_model``, ``score_batch``)."""
        def text(n: Node) -> str:
            if not n.split:
                return f"{n.value!r}D"
            return (f"CASE WHEN `{self.features[n.feature]}` <= {n.threshold!r}D "
                    f"THEN {text(n.left)} ELSE {text(n.right)} END")
        total = f"{self.base!r}D" + "".join(
            f" + {w!r}D * {text(t)}" for t, w in zip(self.trees, self.weights))
        ok = " AND ".join(f"`{c}` IS NOT NULL AND NOT isnan(`{c}`)" for c in self.features)
        return PipelineModel([SQLTransformer(
            statement=f"SELECT *, CASE WHEN {ok} THEN {total} END AS prediction FROM __THIS__")])

    def ensemble(self) -> Ensemble:
        """For :func:`featflow.operators.treeshap.shap_values` (the base is the
        value of a tree of one leaf)."""
        trees = [Tree.from_nodes([{"id": 0, "feature": -1, "threshold": 0.0, "left": -1,
                                   "right": -1, "value": self.base, "cover": 1.0}])]
        for root in self.trees:
            rows, todo = [], [root]
            while todo:
                n = todo.pop()
                inner = n.split
                rows.append({"id": n.heap, "feature": n.feature if inner else -1,
                             "threshold": n.threshold, "left": 2 * n.heap if inner else -1,
                             "right": 2 * n.heap + 1 if inner else -1, "value": n.value,
                             "cover": float(n.weight)})
                todo += [n.left, n.right] if inner else []
            ids = {r["id"]: i for i, r in enumerate(rows)}
            for r in rows:
                r["id"] = ids[r["id"]]
                r["left"], r["right"] = ids.get(r["left"], -1), ids.get(r["right"], -1)
            trees.append(Tree.from_nodes(rows))
        return Ensemble(trees, [1.0, *self.weights], list(self.features))


def _valid(cols: Sequence[str]) -> Column:
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(f"`{c}`").isNotNull() & ~F.isnan(F.col(f"`{c}`").cast("double"))
    return ok


def _value(node: Node, goes_left: Callable[[Node], Column]) -> Column:
    if not node.split:
        return F.lit(node.value)
    return F.when(goes_left(node), _value(node.left, goes_left)).otherwise(
        _value(node.right, goes_left))


# ------------------------------------------------------------------ binning
def quantile_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Cut values per feature: distinct quantiles from one mergeable sketch pass
    (rank error at most 1 / 10,000); the largest value is no cut."""
    probs = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), probs, 10_000).alias(f"q{i}")
                   for i, c in enumerate(features)],
                 *[F.max(F.col(f"`{c}`").cast("double")).alias(f"m{i}")
                   for i, c in enumerate(features)]).first()
    return [[x for x in dict.fromkeys(row[f"q{i}"] or []) if x < row[f"m{i}"]]
            for i in range(len(features))]


def _bin(feature: Column, edges: Sequence[float]) -> Column:
    """How many edges lie below the value."""
    cuts = F.array(*[F.lit(float(e)) for e in edges]) if edges else None
    if cuts is None:
        return F.lit(0)
    return F.size(F.filter(cuts, lambda e: e < feature.cast("double")))


class _Rows:
    """Binned training rows in the shared folder, rewritten when told."""

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.path = None
        self.write(df)

    def write(self, df: DataFrame) -> None:
        path = fresh_path(self.spark, "stage", "binned")
        df.write.parquet(path)
        self.frame = self.spark.read.schema(df.schema).parquet(path)
        self.close()
        self.path = path

    def close(self) -> None:
        if self.path:
            delete_path(self.spark, self.path)


def _binned(df: DataFrame, features, label, edges, bins, keys=()):
    """(binned rows, edges)"""
    ok = df.where(_valid([*features, label]))
    edges = edges or quantile_edges(ok, features, bins)
    for e in edges:
        if list(e) != sorted(set(e)):
            raise ValueError("edges must ascend")
    cols = [_bin(F.col(f"`{c}`"), e).cast("smallint").alias(f"b{i}")
            for i, (c, e) in enumerate(zip(features, edges))]
    kept = [F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]
    return _Rows(spread(ok).select(*cols, F.col(f"`{label}`").cast("double").alias("y"), *kept)), edges


def _fixed(x: Column, scale: float) -> Column:
    return F.floor(x * F.lit(float(scale)) + F.lit(0.5)).cast("long")


def fixed_point(rows: DataFrame) -> float:
    """The largest power of two (at most 2^40) at which sums of labels fit."""
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs("y")).alias("top")).first()
    bits = 61 - math.ceil(math.log2(max(r["n"] * 2, 1) * max(r["top"] or 1.0, 1e-300)))
    return 2.0 ** min(40, bits)


# ------------------------------------------------------------------ growing
def _best_split(node: Node, edges, min_leaf: int, reg: float, allowed: Sequence[int]) -> None:
    """Best (gain, then first feature, then first cut) of a node with a histogram."""
    total = float(node.grad) * float(node.grad) / (node.weight + reg) if node.weight else 0.0
    for f in allowed:
        cuts = len(edges[f])
        if not cuts:
            continue
        w, g = np.cumsum(node.hist[f], axis=0)[:cuts].T
        lw, lg = w.astype(float), g.astype(float)
        rw, rg = (node.weight - w).astype(float), (node.grad - g).astype(float)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = lg * lg / (lw + reg) + rg * rg / (rw + reg) - total
        gain[(w < min_leaf) | (node.weight - w < min_leaf) | ~np.isfinite(gain)] = 0.0
        cut = int(gain.argmax())
        if gain[cut] > node.gain:
            node.gain, node.feature, node.cut = float(gain[cut]), f, cut
            node.threshold = float(edges[f][cut])


def grow(rows: DataFrame, grad: Column, weight: Column, edges, leaves: int, depth: int | None,
         min_leaf: int, reg: float, subset: Callable[[int], Sequence[int]]) -> Node:
    """One tree, best leaf first.  ``grad`` and ``weight`` are whole numbers;
    ``subset`` gives the features a node (by heap index) may split on."""
    width = max(len(e) for e in edges) + 1
    features = range(len(edges))
    base = rows.select(F.array(*[F.col(f"b{i}").cast("int") for i in features]).alias("bins"),
                       *[F.col(f"b{i}") for i in features], grad.alias("g"), weight.alias("w"))

    def histograms(nodes: list[Node], root: Node | None) -> dict[int, np.ndarray]:
        where = F.lit(1)
        if root is not None:
            wanted = {n.heap for n in nodes}

            def heap(n: Node) -> Column:
                if n.heap in wanted or n.left is None:
                    return F.lit(n.heap)
                return F.when(F.col(f"b{n.feature}") <= n.cut, heap(n.left)).otherwise(heap(n.right))
            where = heap(root)
        at = base.select(where.alias("node"), "bins", "g", "w").where(F.col("w") > 0)
        if root is not None:
            at = at.where(F.col("node").isin(sorted(wanted)))
        sums = at.select("node", "g", "w", F.posexplode("bins").alias("f", "b")).groupBy(
            "node", "f", "b").agg(F.sum("w").alias("w"), F.sum("g").alias("g")).collect()
        out = {n.heap: np.zeros((len(edges), width, 2), np.int64) for n in nodes}
        for r in sums:
            out[r["node"]][r["f"], r["b"]] = r["w"], r["g"]
        return out

    def ready(node: Node, hist: np.ndarray) -> None:
        node.hist = hist
        node.weight, node.grad = (int(x) for x in hist[0].sum(axis=0))
        if depth is None or node.depth < depth:
            _best_split(node, edges, min_leaf, reg, subset(node.heap))

    root = Node(0, 0)
    ready(root, histograms([root], None)[1])
    frontier, made = [root], 1
    while made < leaves:
        best = max(frontier, key=lambda n: (n.gain, -n.label))
        if best.gain <= 0:
            break
        if best.left is None:
            # Children of every leaf that may be split before the tree is full.
            todo = sorted((n for n in frontier if n.gain > 0 and n.left is None),
                          key=lambda n: -n.gain)[:leaves - made]
            for n in todo:
                n.left, n.right = Node(0, 0, 2 * n.heap), Node(0, 0, 2 * n.heap + 1)
            found = histograms([n.left for n in todo], root)
            for n in todo:
                ready(n.left, found[n.left.heap])
                ready(n.right, n.hist - found[n.left.heap])
        best.split, best.hist = True, None
        best.left.label, best.right.label = best.label, made
        frontier.remove(best)
        frontier += [best.left, best.right]
        made += 1
    return root


def _finish(root: Node, scale: float, reg: float) -> Node:
    """Values of all nodes; histograms and children not used are dropped."""
    todo = [root]
    while todo:
        n = todo.pop()
        n.hist = None
        n.value = n.grad / (n.weight + reg) / scale if n.weight + reg else 0.0
        if n.split:
            todo += [n.left, n.right]
        else:
            n.left = n.right = None
    return root


# ----------------------------------------------------------------- learners
def fit_boosted(df: DataFrame, features: Sequence[str], label: str, rounds: int = 100,
                leaves: int = 32, rate: float = 0.1, bins: int = 64, min_leaf: int = 20,
                reg: float = 0.0, edges: Sequence[Sequence[float]] | None = None,
                scale: float | None = None, stage_rounds: int = 8) -> HistModel:
    """Gradient boosting of squared loss with leaf-wise trees.

    Every ``stage_rounds`` rounds the rows are written with their prediction so
    far, so that expressions and lineage stay short.
    """
    features = list(features)
    rows, edges = _binned(df, features, label, edges, bins)
    try:
        scale = scale or fixed_point(rows.frame)
        r = rows.frame.agg(F.sum(_fixed(F.col("y"), scale)).alias("s"),
                           F.count(F.lit(1)).alias("n")).first()
        if not r["n"]:
            raise ValueError("no rows to fit")
        model = HistModel(features, r["s"] / r["n"] / scale, [], [])
        rows.write(rows.frame.withColumn("f", F.lit(model.base)))
        score, every = F.col("f"), list(range(len(features)))
        for k in range(rounds):
            if k and k % stage_rounds == 0:
                rows.write(rows.frame.withColumn("f", score))
                score = F.col("f")
            tree = grow(rows.frame, _fixed(F.col("y") - score, scale), F.lit(1).cast("long"), edges,
                        leaves, None, min_leaf, reg, lambda heap: every)
            model.trees.append(_finish(tree, scale, reg))
            model.weights.append(rate)
            score = score + F.lit(rate) * _value(tree, lambda n: F.col(f"b{n.feature}") <= n.cut)
        return model
    finally:
        rows.close()


def bag_weight(keys: Sequence[str], seed: int, tree: int) -> Column:
    """Poisson(1) weight of a row in a tree, from its keys' hash."""
    return _poisson(hash_fraction(keys, seed * 1000 + tree))


def _poisson(u: Column) -> Column:
    total = F.lit(0)
    for p in POISSON:
        total = total + F.when(u >= p, 1).otherwise(0)
    return total.cast("long")


def node_features(seed: int, tree: int, heap: int, features: int, subset: int) -> list[int]:
    """The features a node may split on: those whose hashes are smallest."""
    def h(f):
        return hashlib.md5(f"{seed}:{tree}:{heap}:{f}".encode()).hexdigest()
    return sorted(sorted(range(features), key=h)[:subset])


def fit_forest(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str],
               trees: int = 100, depth: int = 6, subset: int | None = 3, bins: int = 32,
               min_leaf: int = 1, seed: int = 42, bagging: bool = True,
               edges: Sequence[Sequence[float]] | None = None, scale: float | None = None,
               parallel: int = 4) -> HistModel:
    """Random forest; ``keys`` identify a row and decide its bagging weights.

    ``parallel`` trees at a time are prepared in one pass over the rows, which
    adds up rows of equal bins, and grown side by side (as Spark jobs).
    """
    from multiprocessing.pool import ThreadPool
    features = list(features)
    rows, edges = _binned(df, features, label, edges, bins, keys)
    try:
        scale = scale or fixed_point(rows.frame) / 16  # a weight is at most 10
        names = [f"k{i}" for i in range(len(keys))]
        if rows.frame.isEmpty():
            raise ValueError("no rows to fit")
        grown = []
        for first in range(0, trees, parallel):
            some = range(first, min(trees, first + parallel))
            cells = _Rows(_bagged(rows.frame, len(features), names, seed, some, bagging, scale))

            def one(t: int) -> Node:
                return _finish(grow(
                    cells.frame, F.col(f"g{t}"), F.col(f"w{t}"), edges, 1 << depth, depth, min_leaf, 0.0,
                    lambda heap: node_features(seed, t, heap, len(features), subset or len(features))),
                    scale, 0.0)

            try:
                with ThreadPool(parallel) as pool:
                    grown += pool.map(one, some)
            finally:
                cells.close()
        return HistModel(features, 0.0, grown, [1.0 / trees] * trees)
    finally:
        rows.close()


def _bagged(rows: DataFrame, features: int, keys: Sequence[str], seed: int, trees: Sequence[int],
            bagging: bool, scale: float) -> DataFrame:
    """Per combination of bins and per tree the sums of weights and weighted labels.

    A row's key is hashed once per tree; growing a tree then reads the
    combinations, not the rows.
    """
    bins = [f"b{i}" for i in range(features)]
    # Kept as columns of their own: a weight compares its hash ten times.
    hashed = rows.select(*bins, _fixed(F.col("y"), scale).alias("y"), *[
        hash_fraction(keys, seed * 1000 + t).alias(f"u{t}") for t in trees if bagging])
    weighted = hashed.select(*bins, "y", *[
        (_poisson(F.col(f"u{t}")) if bagging else F.lit(1).cast("long")).alias(f"w{t}") for t in trees])
    return weighted.groupBy(*bins).agg(*[
        x for t in trees for x in (F.sum(f"w{t}").alias(f"w{t}"),
                                   F.sum(F.col("y") * F.col(f"w{t}")).alias(f"g{t}"))])


def fit_tree(df: DataFrame, features: Sequence[str], label: str, depth: int = 5, bins: int = 32,
             min_leaf: int = 1, edges: Sequence[Sequence[float]] | None = None,
             scale: float | None = None) -> HistModel:
    """One regression tree on all rows and features."""
    return fit_forest(df, features, label, (), 1, depth, None, bins, min_leaf, bagging=False,
                      edges=edges, scale=scale)
