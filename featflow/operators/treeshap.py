"""Exact path-dependent tree SHAP, distributed over rows with ``mapInPandas``.

A leaf's Shapley share for feature j on its path is

    value * (o_j - z_j) * integral over t in (0, 1) of prod_{g != j} (z_g (1 - t) + o_g t)

over the distinct features g of the path, where ``z_g`` is the product of
child/parent cover ratios over that feature's splits (path-dependent
conditional expectations, Lundberg et al., 2018) and ``o_g`` is 1 when the row
takes all of them.  (The integral of t^s (1-t)^(K-1-s) is the Shapley weight
s!(K-s-1)!/K!.)  The integrand is a polynomial, so Gauss-Legendre quadrature
with half as many nodes as path features is exact.

Per tree one walk suffices: going down, every node keeps the product of its
path at the quadrature nodes; going up, leaf values times products are summed,
and each edge adds its feature's share of the sum below it (and takes back what
the next edge above on the same feature would have claimed).  Cost per row is
tree nodes x path features / 2, memory is depth x quadrature nodes, so neither
depth nor the number of features is limited.

Row side: Arrow batches, vectorised over the rows of a
batch.  Rows between the same cuts of the model take the same branches of every
tree.  Shares are sums over leaves, so a model is cut into parts (some trees, or
the leaves below a node of one) with few cells between their own cuts; a worker
walks each cell of a part once, whatever the rows, and a row adds up one entry per
part (:class:`Cells`).  No shuffle by key: the output keeps the row id and, on
request, the model's prediction (a few-file input is only dealt over the cores).

``expected + sum(phi)`` equals the model prediction (additivity) for decision
trees, forests (mean of trees) and boosted trees (weighted sum).  Continuous
splits only (``x <= threshold`` goes left), as produced by ``VectorAssembler``.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructField, StructType

from featflow.operators.quantiles import exact_quantiles
from featflow.session import ship_package, spread, staged

# Rows explained together; bounds the memory of a walk (depth x nodes x rows).
_ROWS = 8192
# Stands in for a cover ratio of zero (a branch no training row took).
_TINY = 1e-30
# A worker remembers the shares of all cells of a model that has no more of them,
_KEPT_CELLS = 1 << 17
# or those of its parts, of so many cells each,
_PART_CELLS = 1 << 12
# in so many bytes at most.
_PART_BYTES = 64 << 20


@dataclass
class Tree:
    """Node arrays, root = 0; ``feature == -1`` marks a leaf."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    @staticmethod
    def from_nodes(nodes: Sequence[dict]) -> "Tree":
        n = len(nodes)
        t = Tree(np.full(n, -1, np.int64), np.zeros(n), np.full(n, -1, np.int64),
                 np.full(n, -1, np.int64), np.zeros(n), np.zeros(n))
        for d in nodes:
            i = d["id"]
            t.feature[i] = d["feature"]
            t.threshold[i] = d["threshold"]
            t.left[i] = d["left"]
            t.right[i] = d["right"]
            t.value[i] = d["value"]
            t.cover[i] = d["cover"]
        return t

    def predict(self, X: np.ndarray) -> np.ndarray:
        node = np.zeros(len(X), np.int64)
        while True:
            f = self.feature[node]
            inner = f >= 0
            if not inner.any():
                return self.value[node]
            idx = np.nonzero(inner)[0]
            go_left = X[idx, f[idx]] <= self.threshold[node[idx]]
            node[idx] = np.where(go_left, self.left[node[idx]], self.right[node[idx]])

    def ratio(self, child: int, parent: int) -> float:
        return float(self.cover[child] / self.cover[parent]) if self.cover[parent] > 0 else 0.0

    def cuts(self) -> dict[int, set[float]]:
        """Thresholds per feature."""
        found: dict[int, set[float]] = {}
        for f, t in zip(self.feature.tolist(), self.threshold.tolist()):
            if f >= 0:
                found.setdefault(f, set()).add(t)
        return found

    def below(self, node: int) -> "Tree":
        """The tree with the leaves below ``node`` only: branches off the path to it
        are leaves of value zero."""
        parent = {int(c): i for i in np.nonzero(self.feature >= 0)[0].tolist()
                  for c in (self.left[i], self.right[i])}
        path, i = {node}, node
        while i:
            i = parent[i]
            path.add(i)
        nodes: list[dict] = []

        def copy(i: int, on_path: bool, kept: bool) -> int:
            kept = kept or i == node
            inner = self.feature[i] >= 0 and (on_path or kept)
            at = {"id": len(nodes), "feature": -1, "threshold": 0.0, "left": -1, "right": -1,
                  "value": self.value[i] if kept else 0.0, "cover": self.cover[i]}
            nodes.append(at)
            if inner:
                left, right = int(self.left[i]), int(self.right[i])
                at.update(feature=self.feature[i], threshold=self.threshold[i],
                          left=copy(left, left in path, kept), right=copy(right, right in path, kept))
            return at["id"]

        copy(0, True, False)
        return Tree.from_nodes(nodes)

    def parts(self, most: int) -> list["Tree"] | None:
        """Trees of at most ``most`` cells that add up to this one, each with some of its
        leaves; None if a single leaf's path has more."""
        found, open_nodes = [], [0]
        while open_nodes:
            i = open_nodes.pop()
            part = self.below(i) if i else self
            if math.prod(len(c) + 1 for c in part.cuts().values()) <= most:
                found.append(part)
            elif self.feature[i] < 0:
                return None
            else:
                open_nodes += [int(self.right[i]), int(self.left[i])]
        return found

    def path_features(self) -> int:
        """Most distinct features on any path."""
        most, stack = 0, [(0, frozenset())]
        while stack:
            i, seen = stack.pop()
            if self.feature[i] < 0:
                most = max(most, len(seen))
            else:
                seen = seen | {int(self.feature[i])}
                stack += [(int(self.left[i]), seen), (int(self.right[i]), seen)]
        return most

    def expected_value(self) -> float:
        """Mean leaf value, weighted by the cover ratios of the paths."""
        total, stack = 0.0, [(0, 1.0)]
        while stack:
            i, reach = stack.pop()
            if self.feature[i] < 0:
                total += reach * float(self.value[i])
            else:
                for c in (int(self.left[i]), int(self.right[i])):
                    stack.append((c, reach * self.ratio(c, i)))
        return total

    def add_shap(self, X: np.ndarray, weight: float, phi: np.ndarray) -> None:
        """Add this tree's weighted shares for the rows of ``X`` to ``phi``."""
        features = self.path_features()
        if not features:
            return
        nodes, weights = np.polynomial.legendre.leggauss((features + 1) // 2)
        t = ((nodes + 1) / 2)[:, None]
        w = (weights / 2 * weight)[:, None]

        rest = 1 - t

        def share(o, z, inverse, below):
            return (o - z) * np.einsum("qr,qr->r", below, inverse)

        def walk(i: int, product: np.ndarray, taken: dict) -> np.ndarray:
            """Sum over the leaves below node i of value x path product."""
            f = int(self.feature[i])
            if f < 0:
                return product * float(self.value[i])
            left = (X[:, f] <= self.threshold[i]).astype(np.float64)
            above = taken.get(f)
            total = None
            for child, goes in ((int(self.left[i]), left), (int(self.right[i]), 1 - left)):
                z = max(self.ratio(child, i), _TINY)
                o = goes
                if above is not None:
                    z, o = z * above[1], o * above[0]
                own = t * o
                own += z * rest
                inner = product * own
                if above is not None:
                    inner *= above[2]
                inverse = np.divide(1.0, own, out=own)
                below = walk(child, inner, {**taken, f: (o, z, inverse)})
                gain = share(o, z, inverse, below)
                if above is not None:
                    gain -= share(above[0], above[1], above[2], below)
                phi[:, f] += gain
                if total is None:
                    total = below
                else:
                    total += below
            return total

        # The quadrature weights ride along in the products.
        walk(0, np.repeat(w, len(X), axis=1), {})


@dataclass
class Ensemble:
    """Prediction = ``sum_t weights[t] * trees[t](x)``."""
    trees: list[Tree]
    weights: list[float]
    feature_names: list[str]

    def predict(self, X: np.ndarray) -> np.ndarray:
        return sum(w * t.predict(X) for t, w in zip(self.trees, self.weights))

    def expected_value(self) -> float:
        return float(sum(w * t.expected_value() for t, w in zip(self.trees, self.weights)))

    def shap(self, X: np.ndarray) -> np.ndarray:
        """phi (n x d) for a dense float matrix."""
        X = np.asarray(X, dtype=np.float64)
        phi = np.zeros(X.shape)
        for s in range(0, len(X), _ROWS):
            part = np.asfortranarray(X[s:s + _ROWS])
            out = np.zeros(part.shape, order="F")
            for tree, weight in zip(self.trees, self.weights):
                tree.add_shap(part, weight, out)
            phi[s:s + _ROWS] = out
        return phi


class _Part:
    """Sums of shares, and of predictions in the last column, per cell of the cuts of
    some trees; each is walked when a row first falls into it."""

    def __init__(self, ensemble: Ensemble, cuts: Sequence[np.ndarray]):
        self.ensemble, self.steps, self.count = ensemble, [], 1
        own: dict[int, set[float]] = {}
        for tree in ensemble.trees:
            for f, ts in tree.cuts().items():
                own.setdefault(f, set()).update(ts)
        for f, ts in sorted(own.items()):
            # Per place between the model's cuts, that between the part's own.
            place = np.concatenate([[0], np.cumsum(np.isin(cuts[f], list(ts)))])
            self.steps.append((f, place * self.count))
            self.count *= len(ts) + 1
        self.known = np.zeros(self.count, bool)
        self.sums = np.zeros((self.count, len(cuts) + 1))

    def of(self, X: np.ndarray, places: Sequence[np.ndarray]) -> np.ndarray:
        cell = np.zeros(len(X), np.int64)
        for f, step in self.steps:
            cell += step.take(places[f])
        new = np.nonzero(~self.known.take(cell))[0]
        if len(new):
            at, first = np.unique(cell[new], return_index=True)
            rows = X[new[first]]
            self.sums[at, :-1] = self.ensemble.shap(rows)
            self.sums[at, -1] = self.ensemble.predict(rows)
            self.known[at] = True
        return self.sums.take(cell, axis=0)


class Cells:
    """Shares and predictions by cells of a model's cuts.

    A feature's cuts are the thresholds of all trees on it; a cell lies between
    neighbouring cuts of every feature.  The number of cells is bounded by the
    model alone.  Where it is small, results are kept from batch to batch;
    otherwise those of the model's parts are, and only a model with leaves of very
    many features has each cell of a batch walked.
    """

    def __init__(self, ensemble: Ensemble, width: int):
        self.ensemble = ensemble
        self.cuts = [np.unique(np.concatenate(
            [t.threshold[t.feature == j] for t in ensemble.trees])) for j in range(width)]
        self.count = math.prod(len(c) + 1 for c in self.cuts)
        self.parts = self._parted(width)

    def _parted(self, width: int) -> list[_Part] | None:
        """Parts to add up, or None.  The whole model is one if that takes less walking."""
        most, groups, size, walks = _PART_CELLS, [], 0, 0
        for tree, weight in zip(self.ensemble.trees, self.ensemble.weights):
            parts = tree.parts(most)
            if parts is None:
                groups = None
                break
            for part in parts:
                own = part.cuts()
                for group in groups:  # the first one it fits
                    cuts = {f: group[0].get(f, set()) | own.get(f, set()) for f in {*group[0], *own}}
                    if math.prod(len(c) + 1 for c in cuts.values()) <= most:
                        group[0] = cuts
                        break
                else:
                    group = [own, [], []]
                    groups.append(group)
                group[1].append(part)
                group[2].append(weight)
        names = self.ensemble.feature_names
        if groups is not None:
            counts = [math.prod(len(c) + 1 for c in g[0].values()) for g in groups]
            size, walks = sum(counts), sum(c * len(g[1]) for c, g in zip(counts, groups))
        if self.count <= _KEPT_CELLS and (
                groups is None or self.count * len(self.ensemble.trees) <= 4 * walks):
            return [_Part(self.ensemble, self.cuts)]
        if groups is None or size * (width + 1) * 8 > _PART_BYTES:
            return None
        return [_Part(Ensemble(trees, weights, names), self.cuts) for _, trees, weights in groups]

    def explain(self, X: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phi, predictions) of the rows of ``X``, none of them NaN."""
        if not len(X) or self.parts is None and self.count >= 1 << 62:  # numbers would overflow
            return self._walk(X)
        # Cuts below the value: x <= cut goes left.
        places = [np.searchsorted(cuts, X[:, j], side="left") if len(cuts) else None
                  for j, cuts in enumerate(self.cuts)]
        if self.parts is None:
            cell = np.zeros(len(X), np.int64)
            for place, cuts in zip(places, self.cuts):
                if place is not None:
                    cell = cell * (len(cuts) + 1) + place
            _, first, at = np.unique(cell, return_index=True, return_inverse=True)
            phi, prediction = self._walk(X[first])
            return phi[at], prediction[at]
        total = self.parts[0].of(X, places)
        for part in self.parts[1:]:
            total += part.of(X, places)
        return total[:, :-1], total[:, -1]

    def _walk(self, X: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.ensemble.shap(X), np.asarray(self.ensemble.predict(X), np.float64)


#: The cells of the model that this worker explained last.
_REMEMBERED: dict[str, Cells] = {}


def remembered_cells(key: str, ensemble: Ensemble, width: int) -> Cells:
    """The cells of a model, kept by a worker from task to task."""
    if key not in _REMEMBERED:
        _REMEMBERED.clear()
        _REMEMBERED[key] = Cells(ensemble, width)
    return _REMEMBERED[key]


# ------------------------------------------------------- from Spark ML models
def ensemble_from_spark(spark: SparkSession, model, feature_names: Sequence[str],
                        path: str | None = None) -> Ensemble:
    """Tree structure of a fitted Spark ML tree regressor (or its pipeline).

    The model is saved to shared storage and its node table read back; the
    collected rows are bounded by the model size (trees x nodes), not data.
    Cuts between the bins of a pipeline that bins its features become
    thresholds of the features.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import Bucketizer

    from featflow.session import fresh_path

    splits = None
    if isinstance(model, PipelineModel):
        binned = [s for s in model.stages if isinstance(s, Bucketizer)]
        splits = binned[0].getSplitsArray() if binned else None
        model = model.stages[-1]
    kind = type(model).__name__
    path = path or fresh_path(spark, "tree-model", kind)
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    node_cols = ["id", "prediction", "impurityStats", "leftChild", "rightChild", "split"]
    if "treeID" in data.columns:
        rows = data.select("treeID", *[F.col(f"nodeData.{c}").alias(c) for c in node_cols]) \
            .collect()
        meta = spark.read.parquet(f"{path}/treesMetadata").collect()
        tw = {int(r[0]): float(r[2]) for r in meta}
    else:
        rows = data.select(F.lit(0).alias("treeID"), *node_cols).collect()
        tw = {0: 1.0}
    def threshold(split) -> float:
        t = float(split["leftCategoriesOrThreshold"][0])
        if splits is None:
            return t
        # Bins up to t go left: values below the start of the next bin.
        return float(np.nextafter(splits[split["featureIndex"]][math.floor(t) + 1], -np.inf))

    by_tree: dict[int, list] = {}
    for r in rows:
        split = r["split"]
        if r["leftChild"] >= 0 and split["numCategories"] != -1:
            raise ValueError("categorical splits are not supported")
        by_tree.setdefault(int(r["treeID"]), []).append({
            "id": int(r["id"]),
            "feature": int(split["featureIndex"]) if r["leftChild"] >= 0 else -1,
            "threshold": threshold(split) if r["leftChild"] >= 0 else 0.0,
            "left": int(r["leftChild"]), "right": int(r["rightChild"]),
            "value": float(r["prediction"]), "cover": float(r["impurityStats"][0]),
        })
    ids = sorted(by_tree)
    trees = [Tree.from_nodes(by_tree[i]) for i in ids]
    if kind.startswith("RandomForest"):
        weights = [1.0 / len(trees)] * len(trees)
    else:
        weights = [tw[i] for i in ids]
    return Ensemble(trees, weights, list(feature_names))


# ------------------------------------------------------------ Spark operator
def shap_values(df: DataFrame, ensemble: Ensemble, feature_cols: Sequence[str] | None = None,
                id_cols: Sequence[str] = (), dtype: str = "float",
                prefix: str = "", prediction_col: str | None = None) -> DataFrame:
    """Per row: ``id_cols``, ``expected_value`` and one phi column per feature,
    and the ensemble's prediction where ``prediction_col`` names a column.

    Rows with a null or NaN feature are skipped (as the assembler's
    ``handleInvalid='skip'`` does in training).  ``dtype='float'`` gives FLOAT
    phi columns like the original per-feature schema; ``'double'`` keeps full
    precision.
    """
    feats = list(feature_cols or ensemble.feature_names)
    ids = list(id_cols)
    ok = F.lit(True)
    for c in feats:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    # An id column may be a feature, too.
    xs = [f"_ff_x{j}" for j in range(len(feats))]
    src = df.where(ok).select(*ids, *[F.col(c).cast("double").alias(x)
                                      for c, x in zip(feats, xs)])
    phi_type = FloatType() if dtype == "float" else DoubleType()
    id_fields = src.schema.fields[:len(ids)]
    schema = StructType(id_fields + [StructField("expected_value", DoubleType())]
                        + [StructField(prefix + c, phi_type) for c in feats]
                        + ([StructField(prediction_col, DoubleType())] if prediction_col else []))
    np_type = np.float32 if dtype == "float" else np.float64
    model, key = ensemble, uuid.uuid4().hex
    # Row-local, CPU-heavy work: spread a few-partition input over the cores.
    src = spread(src)
    # The closure refers to this module; workers must be able to import it.
    ship_package(src.sparkSession)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = model.expected_value()
        cells = remembered_cells(key, model, len(feats))
        for pdf in batches:
            X = pdf[xs].to_numpy(dtype=np.float64)
            phi, prediction = cells.explain(X)
            out = pdf[ids].copy() if ids else pd.DataFrame(index=pdf.index)
            out["expected_value"] = base
            for j, c in enumerate(feats):
                out[prefix + c] = phi[:, j].astype(np_type)
            if prediction_col:
                out[prediction_col] = prediction
            yield out

    return src.mapInPandas(explain, schema)


def shap_summary(shap_df: DataFrame, feature_cols: Sequence[str],
                 quantiles: bool = True) -> DataFrame:
    """Global importance: per feature its rank, mean |phi|, mean phi and the
    exact quartiles of |phi|; rank 1 has the largest mean |phi| (ties by name).

    The data behind a summary plot.  Means are one partial aggregation over an
    unpivot, the rank is over one row per feature.  For the quartiles the shares
    are staged for the length of the call and their ranks are found by narrowing
    histograms (:mod:`featflow.operators.quantiles`): no task holds more than the
    cells of a histogram.  The result then has one row per feature, kept by the
    driver.
    """
    order = Window.orderBy(F.desc("mean_abs_shap"), "feature")

    def means(src: DataFrame) -> DataFrame:
        phi = F.col("phi").cast("double")
        out = src.unpivot([], list(feature_cols), "feature", "phi").groupBy("feature") \
            .agg(F.avg(F.abs(phi)).alias("mean_abs_shap"), F.avg(phi).alias("mean_shap"))
        return out.withColumn("rank", F.row_number().over(order))

    if not quantiles:
        return means(shap_df)
    spark = shap_df.sparkSession
    with staged(spark, shap_df.select(*feature_cols), "shap") as shares:
        rows = means(shares).collect()  # one per feature
        size = shares.select(*[F.abs(F.col(c).cast("double")).alias(c) for c in feature_cols])
        at = exact_quantiles(size, feature_cols, (0.25, 0.5, 0.75))
    return spark.createDataFrame(
        [(r["feature"], r["mean_abs_shap"], r["mean_shap"],
          None if None in at[r["feature"]] else at[r["feature"]], r["rank"]) for r in rows],
        "feature string, mean_abs_shap double, mean_shap double, abs_quartiles array<double>, "
        "rank int")


def shap_ranked(shap_df: DataFrame, feature_cols: Sequence[str], id_cols: Sequence[str],
                top: int | None = None) -> DataFrame:
    """Per row, features ordered by |phi| (ties by name): the force-plot data.

    Done inside each row with array functions -- no shuffle, no window.
    """
    entries = F.array(*[
        F.struct(F.abs(F.col(c).cast("double")).alias("a"), F.lit(c).alias("feature"),
                 F.col(c).cast("double").alias("phi"))
        for c in feature_cols
    ])
    ordered = F.array_sort(entries, lambda l, r: F.when(l["a"] > r["a"], -1)
                           .when(l["a"] < r["a"], 1)
                           .when(l["feature"] < r["feature"], -1)
                           .when(l["feature"] > r["feature"], 1).otherwise(0))
    if top is not None:
        ordered = F.slice(ordered, 1, top)
    return shap_df.select(*id_cols, "expected_value", F.posexplode(ordered).alias("pos", "e")) \
        .select(*id_cols, "expected_value", (F.col("pos") + 1).alias("rank"),
                F.col("e.feature").alias("feature"), F.col("e.phi").alias("phi"))
