"""Tree SHAP inside the JVM: a share table joined by interval masks.

A leaf's share for a feature (see :mod:`featflow.operators.treeshap`) depends on
the row only through which of the path's feature intervals hold the row's value.
So a model becomes two tables:

* leaves: per distinct path feature an interval ``(low, high]``; a row sets one
  mask bit for each interval that holds its value;
* shares: for every leaf and mask the shares of all features.

A row gets one mask per leaf (native expressions over constant arrays, in
generated code), looks its shares up by (leaf, mask) in a broadcast hash join,
and sums them.  The sum combines on the map side, where all leaves of a row
are, so the one shuffle moves a row of sums per input row.  There is no Python
on the row path.

The share table has ``2 ** features`` rows for a path of so many distinct
features.  Its size is computed beforehand; above ``max_bytes`` the model is
explained by the walk of :mod:`featflow.operators.treeshap`, whose memory does
not depend on that number, with the same result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featflow.operators.treeshap import Ensemble, shap_values
from featflow.session import stage

#: Largest share table that is broadcast.
MAX_SHARE_BYTES = 64 << 20


@dataclass
class Leaf:
    """Weighted value and, by path feature, ``(low, high, cover ratio)``."""
    value: float
    path: dict[int, tuple[float, float, float]]


def leaves(ensemble: Ensemble) -> list[Leaf]:
    """All leaves of all trees."""
    out = []
    for tree, weight in zip(ensemble.trees, ensemble.weights):
        stack = [(0, {})]
        while stack:
            i, path = stack.pop()
            f = int(tree.feature[i])
            if f < 0:
                out.append(Leaf(weight * float(tree.value[i]), path))
                continue
            lo, hi, z = path.get(f, (-math.inf, math.inf, 1.0))
            at = float(tree.threshold[i])
            for child, low, high in ((int(tree.left[i]), lo, min(hi, at)),
                                     (int(tree.right[i]), max(lo, at), hi)):
                stack.append((child, {**path, f: (low, high, z * tree.ratio(child, i))}))
    return out


def _shares(leaf: Leaf) -> np.ndarray:
    """Share of each path feature (columns) for each mask (rows)."""
    k = len(leaf.path)
    masks = np.arange(1 << k)
    if not k:
        return np.zeros((1, 0))
    o = (masks[:, None] >> np.arange(k) & 1).astype(np.float64)
    z = np.array([p[2] for p in leaf.path.values()])
    nodes, weights = np.polynomial.legendre.leggauss((k + 1) // 2)
    t = (nodes + 1) / 2
    # masks x features x quadrature nodes
    factors = z[:, None] * (1 - t) + o[:, :, None] * t
    out = np.empty((1 << k, k))
    for j in range(k):
        others = np.prod(np.delete(factors, j, axis=1), axis=1)
        out[:, j] = leaf.value * (o[:, j] - z[j]) * (others * (weights / 2)).sum(axis=1)
    return out


def share_bytes(found: Sequence[Leaf], features: int) -> int:
    """Size of the share table, without building it."""
    return sum(1 << len(x.path) for x in found) * 8 * (features + 1)


def share_table(found: Sequence[Leaf], features: int) -> tuple[pd.DataFrame, list[int]]:
    """``entry, phi_0, phi_1, ...``; and for each leaf its first entry, to which
    the row's mask is added."""
    starts, blocks, at = [], [], 0
    for x in found:
        part = _shares(x)
        block = np.zeros((len(part), features))
        block[:, list(x.path)] = part
        starts.append(at)
        blocks.append(block)
        at += len(part)
    table = pd.DataFrame(np.concatenate(blocks), columns=[f"phi_{j}" for j in range(features)])
    table.insert(0, "entry", np.arange(at, dtype=np.int64))
    return table, starts


def _constants(values: Sequence, kind: str) -> Column:
    """A constant array, in one literal however long it is."""
    text = ",".join("Infinity" if v == math.inf else "-Infinity" if v == -math.inf else repr(v)
                    for v in values)
    return F.split(F.lit(text), ",").cast(f"array<{kind}>")


def shap_values_sql(df: DataFrame, ensemble: Ensemble, feature_cols: Sequence[str] | None = None,
                    id_cols: Sequence[str] = (), prefix: str = "",
                    max_bytes: int = MAX_SHARE_BYTES) -> DataFrame:
    """The rows of :func:`featflow.operators.treeshap.shap_values` with
    ``dtype='double'``: ``id_cols``, ``expected_value`` and one column per feature.

    Rows with a null or NaN feature are skipped.  Rows alike in ids and features
    are counted and explained once, so repeated rows all come back.  Id columns
    need a type that can be grouped (no map).
    """
    feats = list(feature_cols or ensemble.feature_names)
    ids = list(id_cols)
    found = leaves(ensemble)
    if share_bytes(found, len(feats)) > max_bytes:
        return shap_values(df, ensemble, feats, ids, dtype="double", prefix=prefix)
    spark = df.sparkSession
    table, starts = share_table(found, len(feats))
    # Bounded by max_bytes.
    shares = F.broadcast(stage(spark, spark.createDataFrame(table), "shap-shares"))

    ok = F.lit(True)
    for c in feats:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    xs = [f"x{j}" for j in range(len(feats))]
    rows = df.where(ok).select(
        F.struct(F.lit(0).alias("none"), *[F.col(c).alias(f"id{i}") for i, c in enumerate(ids)])
        .alias("id"),
        *[F.col(c).cast("double").alias(x) for c, x in zip(feats, xs)])
    rows = rows.select("*", F.array(*xs).alias("x"),
                       F.explode(F.sequence(F.lit(0), F.lit(len(found) - 1))).alias("leaf"))
    entry = _constants(starts, "bigint")[F.col("leaf")]
    for s in range(max(len(x.path) for x in found)):
        # A leaf with a shorter path gets an interval that holds nothing.
        slot = [list(x.path.items())[s] if s < len(x.path) else (0, (math.inf, math.inf, 0.0))
                for x in found]
        x = F.col("x")[_constants([f for f, _ in slot], "int")[F.col("leaf")]]
        low = _constants([float(p[0]) for _, p in slot], "double")[F.col("leaf")]
        high = _constants([float(p[1]) for _, p in slot], "double")[F.col("leaf")]
        # Without a lower split the interval holds minus infinity, too.
        inside = ((x > low) | (low == F.lit(-math.inf))) & (x <= high)
        entry = entry + F.when(inside, F.lit(1 << s)).otherwise(F.lit(0))
    sums = (rows.select("id", *xs, entry.alias("entry"))
            .join(shares, "entry")
            .groupBy("id", *xs)
            .agg(*[F.sum(f"phi_{j}").alias(f"phi_{j}") for j in range(len(feats))],
                 (F.count(F.lit(1)) / len(found)).cast("int").alias("copies")))
    return sums.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select(
        *[F.col(f"id.id{i}").alias(c) for i, c in enumerate(ids)],
        F.lit(ensemble.expected_value()).alias("expected_value"),
        *[(F.col(f"phi_{j}") / F.col("copies")).alias(prefix + c) for j, c in enumerate(feats)])
