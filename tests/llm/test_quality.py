import re
from collections import Counter

import pytest

from featflow.llm import quality
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, host string, kept string"


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    win = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    c = Counter(win)
    hit = {i + k for i, w in enumerate(win) if c[w] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(ch in "#*$%&|<>" for ch in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(hit), len(lines))


@pytest.mark.parametrize("text", [None, "", " \n\t", "a", "a b c d e f", "x y z " * 40, "é ü ñ |a| <b>\n\n x\nx\n x",
                                  "a b c d e f a b c d e g a b c d e", "a\n" * 9, "a a a a a a"])
def test_measures(text):
    assert quality.measure_text(None if text is None else text.encode()) == brute(text)


def test_long_texts_count_alike(monkeypatch):
    import random
    rng = random.Random(0)
    for n in (0, 1, 4, 5, 6, 30, 400):
        for vocabulary in (1, 2, 5, 40):
            text = " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randrange(1, 1 + vocabulary)
                            for _ in range(n)).encode()
            monkeypatch.setattr(quality, "LONG_TEXT", 1 << 16)
            want = quality.measure_text(text)
            monkeypatch.setattr(quality, "LONG_TEXT", 5)
            assert quality.measure_text(text) == want
    monkeypatch.undo()
    assert quality.measure_text(b"word " * 200_000)[4] == 200_000


def test_matches_sql(spark):
    r = compare(spark, duck(SF), "op7", quality.op7_quality, quality.SQL_OP7, SF)
    assert r["status"] == "exact", r


def test_prior_shrinks():
    a, b = quality.beta_prior(50, 1000, 0.04, 0.01)
    assert 0 < a < b and abs(a / (a + b) - 0.05) < 1e-12
    assert quality.beta_prior(0, 0, 0.0, 0.0) == (0.0, 1e6)


GOOD = " ".join(f"word{i}" for i in range(40))


def hosts():
    """Hosts whose failure rates differ beyond chance, and what each keeps."""
    odd = GOOD + " &&&&&&&&&&"  # an excess of 2.4
    awful = GOOD + " " + "&" * 40
    near = GOOD + " &&&&"  # within the limit, but near it
    rows, kept = [], set()

    def add(text, host, stays):
        rows.append((len(rows), text, "en", host, 1, "h", "k"))
        if stays:
            kept.add(len(rows) - 1)
    for h in range(8):  # clean, ordinary and bad hosts
        for i in range(300):
            bad = i % 100 < (0, 0, 27, 28, 28, 30, 60, 60)[h]
            add(awful if bad else GOOD + f" {i}", f"host{h}", not bad)
        add(odd, f"host{h}", h < 2)
        add(awful, f"host{h}", False)
        add(near, f"host{h}", h < 6)
    add(None, None, False)
    add(GOOD, None, True)
    return rows, kept


def test_hosts_decide(spark):
    rows, want = hosts()
    docs = spark.createDataFrame(rows, SCHEMA)
    out = quality.quality_filter(docs)
    assert out.columns == docs.columns
    got = {r.doc_id for r in out.collect()}
    assert got == want, sorted(got ^ want)
    rates = {r.host: r.limit for r in quality.host_rates(quality.measure(docs)).collect()}
    assert rates["host0"] == 3.0 and rates["host4"] == 1.0 and rates["host7"] == 0.75 == rates["host6"]
    assert quality.quality_filter(docs.limit(0)).collect() == []


def test_hosts_decide_in_sql_too(spark, tmp_path):
    import duckdb
    rows, want = hosts()
    docs = spark.createDataFrame(rows, SCHEMA)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    got = con.sql(quality.SQL_OP7).fetchall()
    assert {r[0] for r in got if r[7]} == want
    judged = quality.judge(quality.measure(docs), quality.host_rates(quality.measure(docs)))
    assert {r.id for r in judged.where("kept").collect()} == want


def test_alike_hosts_are_ordinary(spark):
    limits = {r["limit"] for r in quality.host_rates(quality.measure(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))).collect()}
    assert limits == {1.0}  # these hosts differ by chance only


def test_clashing_names_and_repeated_rows(spark):
    names = ["doc_id", "text", "source", "n_words", "excess", "host", "limit", "kept", "kept_", "id"]
    rows = [(1, GOOD, "a", 0, "e", "h", "l", "k", "k", 7)] * 2 + [(None, GOOD, None, 0, "e", "h", "l", "k", "k", 7)]
    docs = spark.createDataFrame(rows, ", ".join(
        f"{n} {'long' if n in ('doc_id', 'id', 'n_words') else 'string'}" for n in names))
    out = quality.quality_filter(docs)
    assert out.columns == names and sorted(map(tuple, out.collect()), key=str) == sorted(rows, key=str)
