import functools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from featflow.llm import packing
from featflow.llm.common import WordMemory
from tests.llm.test_tokens import TEXTS, lists

SF = "/root/testdata/sf0.001"
FILE = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def full():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def tok():
    return packing.SegmentTokenizer(open(FILE, "rb").read())


def check_sequences(pieces, capacity):
    """Gapless from 0, at most the capacity, no padding: full or a power of two."""
    by_seq = defaultdict(list)
    for seq, offset, length in pieces:
        assert length > 0
        by_seq[seq].append((offset, length))
    short = []
    for spots in by_seq.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= capacity
        if at < capacity:
            assert at & (at - 1) == 0
            short.append(at)
    assert sorted(by_seq) == list(range(len(by_seq)))
    assert len(set(short)) == len(short) and sum(short) < capacity
    return by_seq


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 31), st.integers(1, 40)), max_size=12), st.integers(0, 3))
def test_every_remainder_gets_its_place(sizes, hot):
    hist = np.zeros(32, np.int64)
    for length, n in sizes:
        hist[length] += n
    if hot and sizes:
        hist[sizes[0][0]] += 400 * hot
    plan = packing.make_plan(hist, 32)
    pieces = []
    for length in range(1, 32):
        for rank in range(hist[length]):
            got = plan.place(length, rank)
            assert sum(n for *_, n in got) == length
            pieces += got
    check_sequences(pieces, 32)
    assert plan.sequences == len({s for s, *_ in pieces})


def best_number(lengths, capacity):
    """Fewest sequences, by trying all ways (few items)."""
    best = [len(lengths)]

    def put(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for k in {rooms[j]: j for j in range(len(rooms)) if rooms[j] >= lengths[i]}.values():
            put(i + 1, rooms[:k] + [rooms[k] - lengths[i]] + rooms[k + 1:])
        put(i + 1, rooms + [capacity - lengths[i]])
    put(0, [])
    return best[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(2, 20), min_size=1, max_size=8), st.integers(1, 500))
def test_linear_program_is_near_its_bound(items, times):
    lengths, counts = np.unique(items, return_counts=True)
    patterns, x, bound = packing.solve_patterns(lengths, counts * times, 20, 1e-6)
    assert (patterns @ lengths <= 20).all() and (x >= 0).all()
    assert np.allclose(x @ patterns, counts * times)
    assert bound <= x.sum() + 1e-6 and x.sum() <= bound * (1 + 1e-6) + 1e-6
    # The relaxation is below the best whole solution for one copy of each.
    assert x.sum() / times <= best_number(sorted(items, reverse=True), 20) + 1e-6


def test_inverse():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 40):
        m = rng.integers(-3, 4, (n, n)) + 9 * np.eye(n)[::-1]
        assert np.allclose((packing.inverse_of(m)[:, :, None] * m[None, :, :]).sum(axis=1), np.eye(n))


def test_columns_beat_the_greedy_start():
    lengths, demand = np.array([23, 31, 40, 47]), np.array([500, 500, 500, 500])
    start, often = packing.greedy_basis(lengths, demand, 100)
    assert np.allclose(often @ start, demand)
    greedy = often.sum()
    patterns, x, bound = packing.solve_patterns(lengths, demand, 100, 1e-6)
    assert x.sum() < greedy - 1 and x.sum() == pytest.approx(bound, rel=1e-6)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(2, 20), min_size=1, max_size=5, unique=True), st.data())
def test_pricing_finds_the_best_pattern(lengths, data):
    lengths = np.array(sorted(lengths))
    values = np.array(data.draw(st.lists(st.integers(-99, 99), min_size=len(lengths),
                                          max_size=len(lengths)))) / 100

    @functools.cache
    def best(room):
        return max([0.0] + [v + best(room - n) for n, v in zip(lengths.tolist(), values) if n <= room and v > 0])
    value, pattern = packing.price(values, lengths, 24)
    assert value == pytest.approx(best(24)) == pytest.approx(pattern @ values) and pattern @ lengths <= 24


def test_patterns_hold_most_tokens():
    rng = np.random.default_rng(5)
    hist = rng.poisson(300 * np.exp(-np.arange(256) / 60))
    hist[0] = 0
    plan = packing.make_plan(hist, 256)
    n = np.arange(256)
    assert plan.used @ n > 0.98 * (hist @ n)  # few documents are cut


def test_tokenizer_equals_library(full, tok):
    for limit in (40 << 20, 2000):
        tok.memory = WordMemory(limit)
        for at in range(0, len(TEXTS), 50):
            some = TEXTS[at:at + 50]
            assert lists(*tok.encode(pa.array(some, pa.string()))) == [
                full.encode(t or "", add_special_tokens=False).ids for t in some]
    assert tok.memory.size < 200_000


def check_query(rows, docs, full, capacity, end):
    """Every id of every document in exactly one piece; sequences without padding."""
    parts = defaultdict(list)
    for r in rows:
        parts[r["doc"]].append(r)
    check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in rows], capacity)
    assert len(parts) == len(docs)
    for doc, text in docs:
        ids = full.encode(text or "", add_special_tokens=False).ids + [end]
        at = 0
        for r in sorted(parts[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            raw = np.array(ids[at:at + r["length"]], "<u4").tobytes()
            assert r["crc"] == zlib.crc32(raw)
            at += r["length"]
        assert at == len(ids)


def test_pack_edges(spark, full):
    rng = random.Random(4)
    texts = [t for t in TEXTS if t is None or len(t) < 9000] + ["word " * n for n in (1, 30, 63, 64, 500)]
    docs = list(enumerate(texts)) + [(10_000 + i, "a b c d") for i in range(300)]
    rng.shuffle(docs)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs],
                               "doc_id long, text string, rest int, part int").repartition(5)
    made = packing.pack(df, FILE, 0, 64).collect()
    rows = [{"doc": r.id, "start": r.start, "length": r.length, "crc": zlib.crc32(r.ids),
             "doc_tokens": r.doc_tokens, "sequence_id": r.sequence_id, "offset": r.offset} for r in made]
    check_query(rows, docs, full, 64, 0)


def test_equal_and_null_keys(spark):
    df = spark.createDataFrame([(None, "a b"), (None, None), (1, "x"), (1, "x")], "doc_id long, text string")
    made = packing.pack(df, FILE, 0, 64).collect()
    assert sum(r.length for r in made) == 3 + 1 + 2 + 2
    assert sorted((r.id is None, r.doc_tokens) for r in made if r.start == 0) == [
        (False, 2), (False, 2), (True, 1), (True, 3)]
    check_sequences([(r.sequence_id, r.offset, r.length) for r in made], 64)


def test_empty_table_and_bad_capacity(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(df, FILE, 0).collect() == []
    with pytest.raises(ValueError):
        packing.pack(df, FILE, 0, packing.MAX_CAPACITY + 1)


def test_query(spark, full):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet")
            .select("doc_id", "text").collect()]
    rows = [{"doc": r.doc_id, "start": r.start, "length": r.length, "crc": r.ids_crc32,
             "doc_tokens": r.doc_tokens, "sequence_id": r.sequence_id, "offset": r.offset}
            for r in packing.op13_packing(spark, SF).collect()]
    check_query(rows, docs, full, 1024, 0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "é", "Z9", "'s", "'", " ", "  ", "\n", "\t", "　", "\xa0", "\x85",
                                          "\x1c", " ", "<|endoftext|>", "<|", "!", "日", "12", "\x00"]),
                         max_size=12).map("".join), max_size=4))
def test_units_begin_matches(full, tok, texts):
    assert lists(*tok.encode(pa.array(texts, pa.string()))) == [
        full.encode(t, add_special_tokens=False).ids for t in texts]
