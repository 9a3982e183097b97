"""Histogram learners against a plain version, on changing layouts, at edges."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featflow.operators import hist_trees as H
from featflow.operators.models import (
    kth_smallest,
    load_model,
    model_dir,
    random_split,
    save_model,
    score_batch,
    split_exact,
)

EDGES = [[1.5 + i for i in range(8)], [0.5], [10.0, 20.0, 30.0]]
NAMES = ["a", "b", "c d"]


def rows(n, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = float(r.randrange(11)), float(r.randrange(2)), r.uniform(0, 40)
        out.append((i, a, b, c, 3 * a + 20 * b * (c > 20) - c + r.gauss(0, 2)))
    return out


def frame(spark, data, parts=3):
    return spark.createDataFrame(data, "id long, a double, b double, `c d` double, y double").repartition(parts)


def plain_boost(data, rounds, leaves, rate, min_leaf, scale):
    """Best-first boosting by trying every cut of every leaf."""
    X = np.array([[sum(e < v for e in edges) for v, edges in zip(r[1:4], EDGES)] for r in data])
    y = np.array([r[4] for r in data])
    f = np.full(len(y), int(np.floor(y * scale + 0.5).sum()) / len(y) / scale)
    for _ in range(rounds):
        g = np.floor((y - f) * scale + 0.5).astype(int)
        leaf = np.zeros(len(y), int)
        for new in range(1, leaves):
            best = (0.0,)
            for k in range(new):
                at = leaf == k
                n, s = int(at.sum()), float(g[at].sum())
                for j, edges in enumerate(EDGES):
                    for cut in range(len(edges)):
                        left = at & (X[:, j] <= cut)
                        ln, ls = int(left.sum()), float(g[left].sum())
                        if min_leaf <= ln <= n - min_leaf:
                            gain = ls * ls / ln + (s - ls) * (s - ls) / (n - ln) - s * s / n
                            if gain > best[0]:
                                best = gain, k, j, cut
            if best[0] <= 0:
                break
            _, k, j, cut = best
            leaf[(leaf == k) & (X[:, j] > cut)] = new
        for k in np.unique(leaf):
            f[leaf == k] += rate * (int(g[leaf == k].sum()) / (leaf == k).sum() / scale)
    return f


@pytest.mark.parametrize("leaves,min_leaf", [(2, 1), (6, 5), (40, 1)])
def test_boosting_equals_plain_version(spark, leaves, min_leaf):
    data = rows(300)
    model = H.fit_boosted(frame(spark, data), NAMES, "y", 3, leaves, 0.3, min_leaf=min_leaf, edges=EDGES,
                          scale=1024.0, stage_rounds=2)
    got = {r.id: r.prediction for r in model.predict(frame(spark, data)).collect()}
    want = plain_boost(data, 3, leaves, 0.3, min_leaf, 1024.0)
    assert np.allclose([got[i] for i in range(len(data))], want, rtol=0, atol=1e-9)


def test_models_do_not_depend_on_the_layout(spark):
    data = rows(400)
    texts = set()
    for parts, stage_rounds in ((1, 8), (7, 1), (3, 2)):
        random.Random(parts).shuffle(data)
        df = frame(spark, data, parts)
        boosted = H.fit_boosted(df, NAMES, "y", 4, 8, edges=EDGES, stage_rounds=stage_rounds)
        forest = H.fit_forest(df, NAMES, "y", ["id"], 4, 3, 2, edges=EDGES)
        texts.add((str(boosted), str(forest)))
    assert len(texts) == 1


def test_leaf_wise_growth_and_quality(spark):
    data = rows(3000)
    train, test = data[:2000], data[2000:]
    model = H.fit_boosted(frame(spark, train), NAMES, "y", 10, 16, 0.5, bins=16)

    def leaves(n):
        return leaves(n.left) + leaves(n.right) if n.split else 1
    assert all(leaves(t) <= 16 for t in model.trees) and leaves(model.trees[0]) == 16
    p = model.predict(frame(spark, test)).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0]
    assert p < 16 < np.var([r[4] for r in test]) / 10


def test_forest_bags_and_subsets(spark):
    data = rows(2000)
    model = H.fit_forest(frame(spark, data), NAMES, "y", ["id"], 12, 4, 2)
    weights = [t.weight for t in model.trees]
    assert len(set(weights)) > 6 and all(1800 < w < 2200 for w in weights)
    assert len({t.feature for t in model.trees}) > 1

    def walk(t, tree):
        assert t.depth <= 4
        if t.split:
            assert t.feature in H.node_features(42, tree, t.heap, 3, 2)
            walk(t.left, tree)
            walk(t.right, tree)
    for k, t in enumerate(model.trees):
        walk(t, k)
    err = model.predict(frame(spark, data)).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0]
    assert err < 0.4 * np.var([r[4] for r in data])


def test_poisson_weights(spark):
    n = 20_000
    got = {r.w: r["count"] for r in spark.range(n).groupBy(
        H.bag_weight(["id"], 1, 2).alias("w")).count().collect()}
    for k in range(4):
        assert abs(got[k] / n - math.exp(-1) / math.factorial(k)) < 0.02


def test_missing_values_and_single_values(spark):
    nan = float("nan")
    data = rows(200) + [(900, None, 1.0, 1.0, 5.0), (901, nan, 1.0, 1.0, 5.0), (902, 1.0, 1.0, 1.0, None),
                        (903, 1.0, 1.0, 1.0, nan)]
    clean = H.fit_boosted(frame(spark, rows(200)), NAMES, "y", 2, 4, edges=EDGES)
    model = H.fit_boosted(frame(spark, data), NAMES, "y", 2, 4, edges=EDGES)
    assert str(model) == str(clean)
    got = {r.id: r.prediction for r in model.predict(frame(spark, data)).collect()}
    assert got[900] is None and got[901] is None and got[902] is not None
    flat = frame(spark, [(i, 2.0, 2.0, 2.0, 7.0) for i in range(50)])
    for made in (H.fit_boosted(flat, NAMES, "y", 2, 4), H.fit_tree(flat, NAMES, "y")):
        assert {r.prediction for r in made.predict(flat).collect()} == {7.0}
    empty = frame(spark, rows(1)).limit(0)
    for fit in (lambda: H.fit_boosted(empty, NAMES, "y", edges=EDGES),
                lambda: H.fit_forest(empty, NAMES, "y", ["id"], edges=EDGES)):
        with pytest.raises(ValueError):
            fit()


def test_saved_scored_and_explained(spark):
    from featflow.operators.treeshap import shap_values
    df = frame(spark, rows(300))
    model = H.fit_boosted(df, NAMES, "y", 3, 5, edges=EDGES)
    fitted = {r.id: r.prediction for r in model.predict(df).collect()}
    path = save_model(model.pipeline(), model_dir(spark, "leafwise"), None, NAMES)
    assert {r.id: r.prediction for r in score_batch(spark, path, df).collect()} == fitted
    assert {r.id: r.prediction for r in load_model(path).transform(df).collect()} == fitted
    shares = shap_values(df, model.ensemble(), NAMES, ["id"], dtype="double", prefix="phi_")
    for r in shares.collect():
        total = r["expected_value"] + sum(r[f"phi_{c}"] for c in NAMES)
        assert total == pytest.approx(fitted[r["id"]], abs=1e-8)


# ------------------------------------------------------------------- splits
def test_kth_smallest(spark):
    r = random.Random(5)
    values = [r.randrange(1 << 60) for _ in range(300)] + [77] * 40
    df = spark.createDataFrame([(v,) for v in values], "v long")
    ordered = sorted(values)
    for k in (1, 20, 40, 41, 200, 340):
        v = ordered[k - 1]
        assert kth_smallest(df, k) == (v, sum(x < v for x in values), values.count(v))
    with pytest.raises(ValueError):
        kth_smallest(df, 341)


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 997])
def test_exact_split(spark, n):
    df = spark.range(n).withColumn("x", F.lit("s"))
    out = split_exact(df, ["id"])
    assert out.where("split = 'test'").count() == math.ceil(n / 4) and out.count() == n
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, split_exact(df.repartition(5), ["id"]).collect()))


def test_exact_split_of_repeated_keys(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.lit(1).alias("x"))
    out = split_exact(df, ["k"], 0.25)
    assert out.where("split = 'test'").count() == 250 and out.count() == 1000


def test_random_split_parts_the_rows(spark):
    df = spark.range(20_000)
    train, test = random_split(df, (0.7, 0.3), 42)
    again = random_split(df, (0.7, 0.3), 42)
    a, b = {r.id for r in train.collect()}, {r.id for r in test.collect()}
    assert not a & b and len(a) + len(b) == 20_000 and abs(len(a) / 20_000 - 0.7) < 0.02
    assert a == {r.id for r in again[0].collect()}


def test_forest_trees_grow_on_combinations_of_bins(spark, monkeypatch):
    """Keys are hashed in one pass per group of trees; growing reads sums per
    combination of bins, however many rows there are."""
    seen, plain = [], H.grow
    monkeypatch.setattr(H, "grow", lambda rows, *a: (seen.append(rows.count()), plain(rows, *a))[1])
    data = rows(1500)
    model = H.fit_forest(frame(spark, data), NAMES, "y", ["id"], 5, 3, 2, edges=EDGES, scale=1024.0,
                         parallel=2)
    assert len(seen) == 5 and max(seen) <= 9 * 2 * 4
    got = spark.createDataFrame(data, "id long, a double, b double, c double, y double").agg(
        *[F.sum(H.bag_weight(["id"], 42, t)).alias(str(t)) for t in range(5)],
        *[F.sum(H.bag_weight(["id"], 42, t) * F.floor(F.col("y") * 1024 + 0.5)).alias(f"g{t}")
          for t in range(5)]).first()
    assert [t.weight for t in model.trees] == list(got)[:5]
    assert [t.grad for t in model.trees] == list(got)[5:]
