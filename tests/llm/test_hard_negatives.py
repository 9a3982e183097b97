import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from featflow.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, q string, score string"


def brute(rows, every=50, positives=5, negatives=3, low=50, high=95):
    """All scores, sorted; rows are (id, vector, label)."""
    rows = [(i, [math.floor(256 * x) for x in v], c) for i, v, c in rows
            if i is not None and v is not None and c is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, c in rows:
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, d) for j, w, d in rows if j != i)
        same = [(-s, j) for s, j, d in scored if d == c][:positives]
        other = [(-s, j) for s, j, d in scored if d != c]
        for s, j in same:
            fits = [(t, n) for t, n in other if low * s <= 100 * t <= high * s][:negatives]
            out += [(i, j, r + 1, n, s, t) for r, (t, n) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hn.mine(df, **more).collect())


def clustered(n, dims, labels, seed):
    """Vectors around centres of their label and of a few topics."""
    r = np.random.default_rng(seed)
    centres, topics = r.normal(size=(labels, dims)), r.normal(size=(3, dims))
    return [(i, (0.6 * centres[i % labels] + topics[i % 3] + 0.5 * r.normal(size=dims))
             .astype("f4").tolist(), i % labels) for i in range(n)]


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 40), st.integers(0, 2 ** 31), st.sampled_from([1, 100, 100_000]))
def test_bounds_hold_on_all_levels(segments, seed, size):
    r = np.random.default_rng(seed)
    q = r.integers(-size, size + 1, (6, segments * 4))
    side = hn.Side(q, *hn.summarize(q))
    true = q.astype(float) @ q.T
    width = np.inf
    for m, d in side.levels:
        mid, far = m @ m.T, d @ d.T + 1e-9 * np.outer(side.norm, side.norm) + 1e-6
        assert (mid - far <= true).all() and (true <= mid + far).all()
        assert far.sum() <= width * (1 + 1e-9) + 1  # finer levels are narrower
        width = far.sum()
    assert side.levels[0][0].shape[1] == 1


def test_levels_drop_pairs_before_scoring():
    rows = clustered(800, 64, 10, 3)
    # Segments with a mean of their own, as summaries presume.
    q = np.array([np.floor(256 * (np.repeat(np.array(v)[:16], 4) + 0.1 * np.array(v))) for _, v, _ in rows])
    a = hn.Side(q, *hn.summarize(q))
    at, tally = np.arange(len(q)), []
    true = q @ q.T
    low = np.sort(true, axis=1)[:, -20]
    i, j, s = hn.pairs_within(a, a, at, at, low, np.full(len(q), np.inf), tally=tally)
    assert (s == true[i, j]).all() and len(i) >= (true >= low[:, None]).sum()
    assert tally[-1] < 0.1 * true.size and tally == sorted(tally, reverse=True)


def test_best_keeps_the_smallest_keys_of_ties():
    best = hn.Best(2, 2)
    best.add(np.array([0, 0, 1]), np.array([5.0, 5, 1]), np.array([9, 7, 3]))
    best.add(np.array([0, 0, 0]), np.array([5.0, 4, 5]), np.array([8, 1, 9]))
    assert best.key[0].tolist() == [7, 8] and best.score[1].tolist() == [1, -np.inf]


@pytest.mark.parametrize("dims,labels", [(64, 10), (7, 2), (1, 3)])
def test_equals_brute_force(spark, dims, labels):
    rows = clustered(400, dims, labels, dims)
    assert mined(spark, rows) == brute(rows)


def test_small_blocks_and_buffers(spark, monkeypatch):
    rows = clustered(500, 16, 4, 8)
    monkeypatch.setattr(hn, "FILE_ANCHORS", 7)
    monkeypatch.setattr(hn, "SEED_SHARE", 3)
    got = mined(spark, rows, anchors_every=10, positives=3, negatives=2, low=20, high=90)
    assert got == brute(rows, 10, 3, 2, 20, 90) and got


def test_edges(spark):
    rows = clustered(220, 8, 3, 1)
    nan, inf = float("nan"), float("inf")
    odd = [(1000, None, 1), (1050, [1.0, None], 1), (1100, [nan] * 8, 0), (1150, [inf] + [0.0] * 7, 0),
           (1200, [1.0] * 8, None), (None, [1.0] * 8, 1), (1250, [], 2), (1300, [0.5] * 3, 1),
           (1350, [0.0] * 8, 77), (-50, [0.25] * 11, 0), (1400, [-0.5] * 8, 1)]
    assert mined(spark, rows + odd) == brute(rows + odd)


def test_hot_vector_and_ties(spark):
    rows = clustered(200, 8, 3, 2)
    rows += [(i, [0.5] * 8, i % 2) for i in range(1000, 1300)]
    assert mined(spark, rows) == brute(rows)


def test_repeated_rows_count(spark):
    rows = clustered(120, 8, 3, 5)
    rows += [rows[3]] * 2 + [rows[4]]
    got = mined(spark, rows)
    assert got == brute(rows)
    twice = mined(spark, rows + [rows[50]])  # a repeated anchor repeats its results
    assert sum(r[0] == 50 for r in twice) == 2 * sum(r[0] == 50 for r in got)


def test_empty_single_and_too_large(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    with pytest.raises(OverflowError):
        mined(spark, [(0, [3e5] * 64, 1), (1, [3e5] * 64, 1)])


def test_query_on_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, None if r.label is None else (r.label + 1) % 10 if r.vec_id % 7 == 0
             else r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in hn.op12_hard_negatives(spark, sf).collect()) == brute(rows)
