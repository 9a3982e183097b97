import random

import numpy as np
import pytest
from pyspark.sql import types as T

from featflow.llm import simhash
from featflow.llm.common import table

SF = "/root/testdata/sf0.001"


def brute_components(fps: dict[int, int], bits: int) -> dict[int, int]:
    ids = sorted(fps)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute_fingerprint(text: str) -> int:
    import re

    import xxhash
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    if not words:
        return 0
    sh = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_covering_loses_no_pair():
    rng = np.random.default_rng(1)
    code = simhash.Covering(2)
    fps = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    anchor, row, home = code.anchors(fps)
    assert (np.bincount(row[home], minlength=300) == 1).all()
    home_of = dict(zip(row[home], anchor[home]))
    for i in range(300):
        flips = rng.choice(64, 2, replace=False)
        other = fps[i:i + 1] ^ np.uint64((1 << int(flips[0])) | (1 << int(flips[1])))
        a, _, _ = code.anchors(other)
        assert home_of[i] in set(a.tolist())


def test_documents_match_brute_force(spark):
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    comp = brute_components(fps, 2)
    got = {r.doc_id: (r.fingerprint, r.component_id)
           for r in simhash.op5_simhash(spark, SF).collect()}
    assert got == {i: (f"{fps[i]:016x}", comp[i]) for i in texts}


@pytest.mark.parametrize("homes", [3, 8192])
def test_dense_clusters_and_hot_anchors(spark, homes):
    rng = random.Random(5)
    vals = []
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(60):
            x = base
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
            vals.append(x)
    vals = sorted(set(vals))
    signed = [v - (1 << 64) if v >> 63 else v for v in vals]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    comp = {r.node: r.root for r in
            simhash.components(simhash.links(df, 2, homes_per_group=homes)).collect()}
    want = brute_components(dict(enumerate(vals)), 2)
    groups, got = {}, {}
    for i, root in want.items():
        groups.setdefault(root, set()).add(signed[i])
    for s in signed:
        got.setdefault(comp.get(s, s), set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_components_of_a_long_path(spark):
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "u long, v long")
    rows = simhash.components(edges).collect()
    assert len(rows) == n + 1 and {r.root for r in rows} == {0}


def test_edge_cases(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("fp", T.StringType()), T.StructField("id", T.StringType())])
    rows = [(5, None, "a", "x"), (3, "", None, None), (9, "  \n", "b", "y"), (7, "One", "c", "z"),
            (8, "one ", "c", "z"), (8, "one ", "c", "z"), (None, "alone here", None, None),
            (11, "word " * 50_000, "d", "w")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows)
    comp = {}
    for r in got:
        comp.setdefault(r.component_id, []).append(r.id)
    assert sorted(comp[3]) == [3, 5, 9] and sorted(comp[7]) == [7, 8, 8]
    assert comp[None] == [None] and comp[11] == [11]
    empty = spark.createDataFrame([], schema)
    assert simhash.near_duplicates(empty).collect() == []


def test_one_row_stays_per_class(spark):
    rows = [(5, None, "a"), (3, "", "b"), (9, " ", "c"), (7, "One", "d"), (8, "one ", "e"), (8, "one ", "e"),
            (8, "other text here", "f"), (None, "alone", "g"), (None, "alone", "g"), (None, "single", None),
            (2, "twice twice", "h"), (2, "twice twice", "h"), (1, "TWICE twice x", "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, th string")
    got = simhash.keep_one_per_class(docs)
    assert got.schema == docs.schema
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [
        (3, "", "b"), (7, "One", "d"), (8, "other text here", "f"), (None, "alone", "g"), (None, "single", None),
        (2, "twice twice", "h"), (1, "TWICE twice x", "i")]))
    assert simhash.keep_one_per_class(docs.limit(0)).collect() == []


def test_clashing_names(spark):
    names = ["doc_id", "text", "key", "text_hash", "times", "KEY_", "_llm_id", "_llm_th", "_llm_n"]
    rows = [(1, "a b c d", *"uvwxyz0"), (2, "a b c d", *"uvwxyz0"), (3, "other words are here", *"uvwxyz0")]
    docs = spark.createDataFrame(rows, ", ".join(
        f"{n} {'long' if n == 'doc_id' else 'string'}" for n in names))
    out = simhash.keep_one_per_class(docs)
    assert out.columns == names and {r.doc_id for r in out.collect()} == {1, 3}
