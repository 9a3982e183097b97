import collections
import zlib

import numpy as np

from featflow.llm import lang_id
from featflow.llm.common import table

SF = "/root/testdata/sf0.001"


def brute_grams(text):
    s = "".join(c if c.isascii() and c.isalpha() or not c.isascii() else " " for c in (text or "").lower())
    b = b" " + b" ".join(s.encode().split(b" ")).strip(b" ") + b" "
    while b"  " in b:
        b = b.replace(b"  ", b" ")
    return [int.from_bytes(b[i:i + 4], "big") for i in range(len(b) - 3)]


def test_grams():
    texts = ["Ab c, dé--f", None, "", "x", "\0ab\0cd", "the the", "ÉÀ!", "a" * 300_000]
    codes, owner = lang_id.grams(texts)
    for i, t in enumerate(texts):
        assert codes[owner == i].tolist() == brute_grams(t), t


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in lang_id.op1_lang_id(spark, SF).collect()}
    docs = table(spark, SF, "documents").collect()
    assert set(rows) == {r.doc_id for r in docs}
    right = n = 0
    for d in docs:
        r = rows[d.doc_id]
        assert r.held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if r.held_out:
            n += 1
            right += r.lang_pred == d.lang
    assert n and right / n > 0.95


def test_masks_and_correction():
    rng = np.random.default_rng(0)
    owned = {f"l{i:03}": rng.integers(0, 1 << 32, 300) for i in range(130)}
    m = lang_id.LanguageFilter.build(owned, {k: i for i, k in enumerate(owned)})
    assert m.planes.shape[0] == 3 and m.fallback == 129
    for i, k in enumerate(m.languages):
        share = m.shares(owned[k].astype(np.uint32), np.zeros(300, np.int64), 1)[0]
        assert share.argmax() == i and share[i] > 0.999 and np.delete(share, i).max() < 0.1


def exact_rates(docs):
    """Language -> n-gram -> its share, by plain counting."""
    found = {}
    for text, lang in docs:
        if text is not None and lang is not None:
            found.setdefault(lang, collections.Counter()).update(brute_grams(text))
    return {k: {g: n / c.total() for g, n in c.items()} for k, c in found.items()}


def test_predictions_equal_exact_sets(spark):
    """Brute force: exact sets instead of a filter, one text at a time."""
    docs = table(spark, SF, "documents")
    rows = docs.select("doc_id", "text", "lang").collect()
    rates = exact_rates([(r.text, r.lang) for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 != 2])
    owned = {k: {g for g, x in v.items() if x >= 5e-5} for k, v in sorted(rates.items())}
    got = {r.doc_id: r for r in lang_id.op1_lang_id(spark, SF).collect()}
    clear = 0
    for r in rows:
        found = brute_grams(r.text)
        shares = {k: sum(g in v for g in found) / max(1, len(found)) for k, v in owned.items()}
        best, second = sorted(shares.values(), reverse=True)[:2]
        if not any(map(str.isalpha, r.text or "")):
            assert got[r.doc_id].lang_pred == "und" and got[r.doc_id].score == 0
            continue
        # False positives are corrected on average: up to their spread in short texts.
        spread = 0.01 + 0.3 / max(1, len(found)) ** 0.5
        assert abs(got[r.doc_id].score - best) < spread, r.doc_id
        if best - second > spread:
            clear += 1
            assert got[r.doc_id].lang_pred == max(shares, key=shares.get), r.doc_id
    assert clear > 0.9 * len(rows)


def test_filter_size_is_bounded(spark):
    """Rates double until the n-grams fit; what stays is what has that rate."""
    rng = np.random.default_rng(5)
    rows = [("".join(chr(97 + x) for x in rng.geometric(0.15, 4000) % 26), f"l{i % 70:02}")
            for i in range(140)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    rates = exact_rates(rows)
    free = lang_id.learn(docs)
    assert free.planes.shape[0] == 2
    for limit in (1 << 16, 1 << 18):
        m = lang_id.learn(docs, max_bytes=limit)
        assert m.planes.nbytes <= limit < free.planes.nbytes
        # The smallest doubling that fits.
        most, level = limit // 16 // 8, 0
        while sum(x >= 5e-5 * 2 ** level for v in rates.values() for x in v.values()) > most:
            level += 1
        assert level > 0
        want = lang_id.LanguageFilter.build(
            {k: np.array(sorted(g for g, x in v.items() if x >= 5e-5 * 2 ** level), np.int64)
             for k, v in rates.items()}, {k: 1 for k in rates})
        assert m.languages == want.languages and np.array_equal(m.planes, want.planes)
    assert lang_id._most_grams(1024, lang_id.MAX_FILTER_BYTES) * 8 * 8 * 16 <= lang_id.MAX_FILTER_BYTES


def test_rows(spark):
    rows = [(1, None, "en", "a", 1.0), (2, "", "en", None, None), (3, "123 !?", None, "b", 2.0),
            (4, "the cat and the dog " * 50, "en", "c", 0.0), (4, "the cat and the dog " * 50, "en", "c", 0.0),
            (5, "der hund und die katze " * 20_000, "de", "c", 0.0), (None, "the dog", None, "c", 0.0),
            (7, "x", None, "c", 0.0), (8, "и", None, "c", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, id string, score double")
    model = lang_id.learn(docs)
    assert model.languages == ["de", "en"]
    got = {}
    for r in lang_id.predict(docs, model).collect():
        got.setdefault(r.id, []).append((r.lang_pred, round(r.score, 3)))
    assert got[1] == got[2] == got[3] == [("und", 0.0)]
    assert [x[0] for x in got[4]] == ["en", "en"] and got[5][0][0] == "de" and got[None][0][0] == "en"
    assert got[7] == got[8] == [("de", 0.0)]
    none = lang_id.learn(docs.limit(0))
    assert {r.lang_pred for r in lang_id.predict(docs, none).collect()} == {"und"}
    assert lang_id.predict(docs.limit(0), model).collect() == []
