import random

import numpy as np
import pytest

from featflow.llm import decontam as D
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.01"


def test_matches_sql(spark):
    r = compare(spark, duck(SF), "op4", D.op4_decontam, D.SQL_OP4, SF)
    assert r["status"] == "exact" and r["rows"] > 5, r


@pytest.mark.parametrize("radius,blocks", [(23, 8), (15, 8), (3, 4), (0, 8)])
def test_multi_index_finds_all(radius, blocks):
    rng = np.random.default_rng(radius)
    stored = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    queries = np.concatenate([rng.integers(0, 1 << 63, 100, dtype=np.uint64), stored[:100]])
    for i in range(100):
        for bit in rng.choice(64, rng.integers(0, 25), replace=False):
            queries[100 + i] ^= np.uint64(1 << int(bit))
    q, s, d = D.MultiIndex(stored, radius, blocks).query(queries)
    dist = np.bitwise_count(queries[:, None] ^ stored[None, :])
    assert sorted(zip(q, s)) == sorted(zip(*np.nonzero(dist <= radius)))
    assert (dist[q, s] == d).all()


def test_radius_covers_similar_windows():
    """No window at the similarity bound differs in more bits than the radius."""
    rng = random.Random(4)
    worst = 0
    for _ in range(3000):
        n = rng.randrange(9, 60)
        words = [rng.getrandbits(64) for _ in range(n)]
        other = list(words)
        for _ in range(rng.randrange(1, 4)):
            other[rng.choice([0, 1, n - 2, n - 1, rng.randrange(n)])] = rng.getrandbits(64)
        a, b = (D.shingle_hashes(np.array(w, np.uint64)) for w in (words, other))
        common = len(set(a.tolist()) & set(b.tolist()))
        if common / (2 * len(a) - common) >= 0.8:
            fa, fb = (D.window_fingerprints(x, np.zeros(1, np.int64), len(x))[0] for x in (a, b))
            worst = max(worst, int(np.bitwise_count(fa ^ fb)))
    assert 0 < worst <= D.RADIUS


def brute(docs, items, least=0.8):
    out = set()
    for d, text in docs:
        w = (text or "").encode().lower().split()
        for i, t in items:
            v = (t or "").encode().lower().split()
            if len(v) >= 5 and any(D.similarity(D._shingle_counts(w[s:s + len(v)]), D._shingle_counts(v)) >= least
                                   for s in range(len(w) - len(v) + 1)):
                out.add((d, i))
    return out


def test_rows_and_blocks(spark, monkeypatch):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    items = [(i, " ".join(word() for _ in range(rng.randrange(3, 40))), "x") for i in range(30)]
    items += [(90, "one two one two one two one two", "x"), (91, None, "x"), (92, "", "x"), (92, "", "x")]
    docs = [(0, None, 1, "e"), (1, "", 1, "e"), (2, "a b c", 1, None)]
    for i in range(3, 60):
        body = [word() for _ in range(rng.randrange(0, 60))]
        _, t, _ = rng.choice(items[:31])
        passage = t.upper().split() if i % 3 else t.split()
        if i % 4 == 0 and passage:
            passage[rng.choice([0, -1])] = "changed"
        body[len(body) // 2:len(body) // 2] = passage
        docs.append((i, "\n".join(body), 1, "e"))
    docs += [(7, docs[7][1], 1, "e"), (None, items[3][1], None, None), (99, "filler " * 100_000 + items[5][1], 1, "e")]
    dd = spark.createDataFrame(docs, "doc_id long, text string, item_id long, similarity string")
    ii = spark.createDataFrame(items, "item_id long, text string, doc_id string")
    want = brute([(d[0], d[1]) for d in docs], [(i[0], i[1]) for i in items])
    for limit in (D.BLOCK_BYTES, 700):
        monkeypatch.setattr(D, "BLOCK_BYTES", limit)
        got = D.find_contamination(dd, ii).collect()
        assert {(r.id, r.item) for r in got} == want
        clean = D.drop_contaminated(dd, ii)
        assert clean.schema == dd.schema
        hit = {d for d, _ in want}
        assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d[0]) for d in docs if d[0] not in hit)
    assert D.find_contamination(dd, ii.limit(0)).collect() == [] and D.drop_contaminated(dd, ii.limit(0)).count() == len(docs)
    assert D.find_contamination(dd.limit(0), ii).collect() == []


def best_windows(docs, items, least=0.8):
    """{(doc, item): (start, words, similarity)}; a shorter document is one window."""
    out = {}
    for d, text in docs:
        w = text.encode().lower().split()
        for i, t in items:
            v = t.encode().lower().split()
            n = min(len(v), len(w))
            if n < D.SHINGLE:
                continue
            found = [(-D.similarity(D._shingle_counts(w[s:s + n]), D._shingle_counts(v)), s)
                     for s in range(len(w) - n + 1)]
            sim, start = min(found)
            if -sim >= least:
                out[d, i] = (start, n, -sim)
    return out


def test_documents_shorter_than_the_item(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(n)))
             for i, n in enumerate([59, 10, 9, 5, *(rng.randrange(9, 60) for _ in range(40))])]
    docs = [(0, " ".join(items[0][1].split()[:52])), (1, " ".join(items[1][1].split()[1:])),
            (2, " ".join(items[2][1].split()[:8])), (3, " ".join(items[3][1].split()[:4]))]
    for d in range(4, 160):
        passage = rng.choice(items)[1].split()
        a = rng.randrange(0, 1 + len(passage) // 8)
        passage = passage[a:len(passage) - rng.randrange(0, 1 + len(passage) // 8)]
        if d % 3 == 0:  # thinned
            del passage[rng.randrange(len(passage))]
        docs.append((d, "\n".join(passage).upper() if d % 2 else " ".join(passage)))
    want = best_windows(docs, items)
    assert want[0, 0] == (0, 52, 48 / 55) and want[1, 1] == (0, 9, 5 / 6) and (3, 3) not in want
    shorter = {(d, i) for d, i in want if len(docs[d][1].split()) < len(items[i][1].split())}
    assert len(shorter) > 50
    dd = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    ii = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.id, r.item): (r.start_word, r.n_words, r.similarity)
           for r in D.find_contamination(dd, ii).collect()}
    assert got == want
    hit = {d for d, _ in want}
    assert sorted(r.doc_id for r in D.drop_contaminated(dd, ii).collect()) == [
        d for d, _ in docs if d not in hit]


def test_similar_windows_beyond_the_radius():
    """Texts of short periods and few words: what the exact similarity says, for any radius."""
    rng = random.Random(11)
    items = [(0, "a b " * 6 + "a"), (1, "a b c " * 7), (2, "z " * 9)]
    items += [(i, " ".join(rng.choice(["ab", "xyz", "pqrstu"][i % 3]) for _ in range(rng.randrange(5, 40))))
              for i in range(3, 60)]
    docs = ["b a " * 6 + "b", "c a b " * 8, "z " * 8, "y " * 40 + "b a " * 30 + "a b c " * 50]
    for _ in range(150):
        words = rng.choice(items)[1].split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice("abxy")
        docs.append(" ".join(["n"] * rng.randrange(3) + words[rng.randrange(3):] + ["m"] * rng.randrange(3)))
    want = best_windows(list(enumerate(docs)), items)
    assert want[0, 0] == (0, 13, 0.8)
    far = 0
    for radius in (D.RADIUS, 0):
        got = D.ItemIndex(items, radius, 0.8).search(D.pa.array(docs))
        assert {(t, i): (start, n, sim) for t, i, start, n, _, sim in got} == want
        far += sum(d > D.RADIUS for *_, d, _ in got)
    assert far
