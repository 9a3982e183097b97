import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from featflow.llm import fill_middle as fim

MARKS = fim.Sentinels()


def plain_version(key, text):
    """The contract, written out with string slices."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    h = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 50 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return n, form, len(p), len(m), out


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=60), st.integers(0, 60), st.integers(0, 60), st.sampled_from(["psm", "spm"]))
def test_rotations_round_trip(text, x, y, form):
    a, b = sorted((min(x, len(text)), min(y, len(text))))
    p, m, s = text[:a], text[a:b], text[b:]
    out = bytes(fim.transform(text, form, a, b, MARKS))
    assert out == (b"<P>" + p + b"<S>" + s + b"<M>" + m if form == "psm"
                   else b"<S>" + s + b"<P>" + p + b"<M>" + m)
    if not any(x in text for x in MARKS):
        assert fim.invert(out, form, MARKS) == text


def test_reversal_in_blocks(monkeypatch):
    monkeypatch.setattr(fim, "_SWAP", 7)
    for n in (0, 1, 2, 13, 14, 15, 100, 101):
        data = np.arange(n, dtype=np.uint8)
        fim.reverse(data)
        assert data.tolist() == list(range(n))[::-1]


def test_edges_equal_plain_version(spark):
    texts = [None, "", "\n", "\n\n", "one", "one\n", "one\ntwo", "é日😀\nß\n\n x", "a <P> b", "<", "<P",
             "S>\n<", "x\r\ny z", "line\n" * 50_000 + "end", "w" * 300_000, "dup", "dup"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "a\nb\nc", "y"), (None, None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string")
    got = fim.restore(fim.fill_in_middle(df)).collect()
    assert len(got) == len(rows)
    want = sorted((repr((k, *plain_version(k, t), t or "")) for k, t, _ in rows))
    assert sorted(repr(tuple(r)) for r in got) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert fim.restore(fim.fill_in_middle(df)).collect() == []


def test_rate_and_forms(spark):
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a\nb\nc\n").alias("text"))
    half = fim.fill_in_middle(df, fim.Draw(rate=50, spm=0)).groupBy("form").count().collect()
    found = {r["form"]: r["count"] for r in half}
    assert set(found) == {"plain", "psm"} and 120 < found["plain"] < 280


def test_overlapping_sentinels_are_refused():
    for marks in ((b"aba", b"S", b"M"), (b"<P>", b"><S", b"<M>"), (b"PP", b"PPP", b"M"), (b"", b"S", b"M")):
        with pytest.raises(ValueError):
            fim.Sentinels(*marks)


def test_query_equals_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet")
            .select("doc_id", "text").collect()}
    got = fim.op11_fill_middle(spark, sf).collect()
    assert len(got) == len(docs)

    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()
    for r in got:
        n, form, p, m, out = plain_version(r.doc_id, docs[r.doc_id])
        assert tuple(r) == (r.doc_id, n, form, p, m, sha(out), sha(docs[r.doc_id] or ""))
