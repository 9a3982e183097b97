import random
from collections import defaultdict

import numpy as np
import pytest

from featflow.llm import suffix_dedup as S
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.01"


def test_matches_sql(spark):
    r = compare(spark, duck(SF), "op8", S.op8_repeats, S.SQL_OP8, SF)
    assert r["status"] == "exact" and r["rows"] > 20, r


def test_minimisers():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 40, 300, dtype=np.uint64) << np.uint64(30)
    for width in (1, 2, 5, 25):
        want = [i + int(np.argmin(h[i:i + width])) for i in range(len(h) - width + 1)]
        assert S.minimisers(h, width).tolist() == want
    assert S.minimisers(h[:3], 25).tolist() == []


def brute(docs, k):
    where = defaultdict(list)
    words = [(t or "").encode().split() for _, t in docs]
    for d, w in enumerate(words):
        for i in range(len(w) - k + 1):
            where[tuple(w[i:i + k])].append((d, i))
    cover = defaultdict(set)
    for spots in where.values():
        if len(spots) > 1:
            for d, i in spots:
                cover[d].add(i)
    out = []
    for d, starts in cover.items():
        starts = sorted(starts)
        a = b = None
        for i in starts:
            if b is not None and i <= b:
                b = i + k
            else:
                if b is not None:
                    out.append((docs[d][0], a, b))
                a, b = i, i + k
        out.append((docs[d][0], a, b))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_overlapping_passages(spark, seed):
    """Shared passages, copies, shifted overlaps, low-entropy text, hot passage."""
    rng = random.Random(seed)
    word = lambda n=200: f"w{rng.randrange(n)}"
    pool = [[word() for _ in range(rng.randrange(40, 90))] for _ in range(6)]
    docs = []
    for i in range(80):
        body = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(pool)
            a = rng.randrange(0, 20) if rng.random() < .5 else 0
            body += [word() for _ in range(rng.randrange(30))] + p[a:len(p) - rng.randrange(0, 8)]
        if i % 3 == 0:
            body += ["license"] * 3 + pool[0]
        docs.append((i, "  \n".join(body), "x", 1))
    docs += [(200, "a b " * 80, "x", 1), (201, "same " * 30, "x", 1), (202, None, "x", 1), (203, "", "x", 1),
             (204, docs[5][1], "x", 1), (204, docs[5][1], "x", 1), (None, docs[7][1], None, None),
             (205, " ".join(word(10**9) for _ in range(30_000)) + " " + " ".join(pool[1]), "x", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, key string, pos int").repartition(5)
    got = sorted(map(tuple, S.repeated_passages(df).collect()), key=str)
    assert got == brute([(d[0], d[1]) for d in docs], 50)
    assert S.repeated_passages(df.limit(0)).collect() == []


def test_only_border_rows_move_to_one_task(spark):
    names = [*S._SORT, "low", "high"]
    rows = [(i // 2, i % 3 // 2, i, 0, 0, 0) for i in range(2000)]
    found = S.neighbours(spark.createDataFrame(rows, ", ".join(f"{n} long" for n in names)).repartition(7))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and "Exchange SinglePartition" in plan
    where = lambda flag: {r.th for r in found.where(flag).collect()}
    same = {i for i in range(2000) if rows[i][1] == rows[i ^ 1][1]}
    assert where("full") == same and where("part") == set(range(2000)) - same


def test_windows_have_a_second_hash(monkeypatch):
    """Windows whose first hashes collide are not taken for repeats."""
    plain = S.word_hashes
    monkeypatch.setattr(S, "word_hashes", lambda words, seed=0: plain(words, seed) * np.uint64(seed != 0))
    words = [f"w{i}" for i in range(120)]
    batch = S.pa.RecordBatch.from_pylist(
        [{"text": " ".join(words), "th": 1, "spans": [{"low": 0, "high": 70}]},
         {"text": "x " + " ".join(words[:60]), "th": 2, "spans": [{"low": 0, "high": 11}]}])
    found = S.pa.Table.from_batches(S._windows(50)([batch])).sort_by([(n, "ascending") for n in S._SORT])
    rows = [r for b in S._compare(found.combine_chunks().to_batches()) for r in b.to_pylist() if r["full"]]
    assert sorted((r["th"], r["low"]) for r in rows) == (
        [(1, i) for i in range(11)] + [(2, i) for i in range(1, 12)])
