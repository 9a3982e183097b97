import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from featflow.llm import byte_bpe, token_files
from featflow.llm.common import table, WordMemory, text_bytes, split_units, split_words

SF = "/root/testdata/sf0.001"
RANKS = P.path("byte_bpe_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")
NASTY = ["", "  ", None, "It's <|endoftext|>don't  \n x    y 'tis 've a'b ﬁ ½ Ⅷ x\x1cy \x85z 　 　a  b",
         "a" * 3000, "abab" * 400, "=-" * 300, " \x1c \x1d x", "日本語" * 90, "<|startoftext|>a H̱ T̈. W̊, İİ ΣΑΣ.",
         "one two " * 20_000]
ALPHABET = "aAbZ09  .,'’-_<|>\n\té́̈ñßK  ​日😀#\x1c\x85　 "
rng = random.Random(3)
TEXTS = NASTY + ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(400)]


def tik():
    ranks = byte_bpe.parse_ranks(open(RANKS, "rb").read())
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.MergeCodec(byte_bpe.parse_ranks(open(RANKS, "rb").read()), P.PATTERN)


@pytest.fixture(scope="module")
def words():
    return token_files.WordTokenizer(open(WORDS, "rb").read())


def lists(ids, bounds):
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


def test_bpe_equals_library(codec):
    enc = tik()
    ids, bounds = codec.encode(pa.array(TEXTS, pa.string()))
    assert lists(ids, bounds) == [enc.encode_ordinary(t or "") for t in TEXTS]
    assert codec.decode(ids, bounds) == [(t or "").encode() for t in TEXTS]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(st.sampled_from("abeti n=- \n"), max_size=700), max_size=5))
def test_bpe_long_words(codec, texts):
    enc = tik()
    ids, bounds = codec.encode(pa.array(texts, pa.string()))
    assert lists(ids, bounds) == [enc.encode_ordinary(t) for t in texts]


def test_bpe_giant_words(codec, monkeypatch):
    enc = tik()
    r = random.Random(9)
    texts = ["".join(r.choice(a) for _ in range(n)) for a in ("etaoinshr", "ab", "語日本x", "=-")
             for n in (1500, 6000)] + ["x" * 50_000, "x" * 3000 + "the" * 900 + "y" * 1111]
    ids, bounds = codec.encode(pa.array(texts))
    assert lists(ids, bounds) == [enc.encode_ordinary(t) for t in texts]
    monkeypatch.setattr(byte_bpe, "DECODE_TOKENS", 777)
    assert codec.decode(ids, bounds) == [t.encode() for t in texts]


def test_memories_may_overflow(codec, words, monkeypatch):
    enc, full = tik(), Tokenizer.from_file(WORDS)
    monkeypatch.setattr(codec, "memory", WordMemory(3000))
    monkeypatch.setattr(words, "memory", WordMemory(3000))
    for at in range(0, len(TEXTS), 40):
        some = TEXTS[at:at + 40] + ["again and again", "x1 y2"]
        col = pa.array(some, pa.string())
        assert lists(*codec.encode(col)) == [enc.encode_ordinary(t or "") for t in some]
        assert lists(*words.encode(col)) == [full.encode(t or "", add_special_tokens=False).ids
                                             for t in some]


def test_memory_is_bounded_in_bytes():
    m = WordMemory(limit=100_000, longest=100)
    for at in range(50):
        m.begin()
        some = [f"{at}:{i}".encode() * (1 + i % 30) for i in range(200)]
        for w in m.unknown(some):
            m[w] = w[::-1]
        assert m.all(some) == [w[::-1] for w in some]
    held = sum(len(w) + len(v) + m.ENTRY for d in (m.new, m.old) for w, v in d.items())
    assert held < 2 * 100_000 + 200 * (2 * 100 + m.ENTRY)


def test_bpe_other_pattern():
    ranks = byte_bpe.parse_ranks(open(RANKS, "rb").read())
    pattern = r"\p{L}{1,4}|\s|[^\s\p{L}]+"
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = ["Some longer words, with... (signs)\n  and 1234's", "é日本 x", ""]
    ids, bounds = byte_bpe.MergeCodec(ranks, pattern).encode(pa.array(texts))
    assert lists(ids, bounds) == [enc.encode_ordinary(t) for t in texts]


def test_bpe_very_long_word_in_time():
    import resource
    import time
    r = random.Random(1)
    text = "".join(r.choice("etaoinshrdlu") for _ in range(400_000))
    codec = byte_bpe.MergeCodec(byte_bpe.parse_ranks(open(RANKS, "rb").read()), P.PATTERN)
    codec.encode(pa.array(["warm up"]))
    before, begin = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.process_time()
    ids, _ = codec.encode(pa.array([text]))
    assert ids.tolist() == tik().encode_ordinary(text)
    assert time.process_time() - begin < 15
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000  # KB


def test_words_equal_library(words):
    full = Tokenizer.from_file(WORDS)
    ids, bounds = words.encode(pa.array(TEXTS, pa.string()))
    assert lists(ids, bounds) == [full.encode(t or "", add_special_tokens=False).ids for t in TEXTS]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \n\té "), max_size=12), max_size=6))
def test_splitting(texts):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    w, bounds, starts, ends = split_words(data, offsets)
    got = [w.to_pylist()[a:b] for a, b in zip(bounds, bounds[1:])]
    assert got == [t.encode().split() for t in texts]
    assert [bytes(data[a:b]) for a, b in zip(starts, ends)] == w.to_pylist()
    s, bounds = split_units(data, offsets)
    assert [b"".join(s.to_pylist()[a:b]) for a, b in zip(bounds, bounds[1:])] == [t.encode() for t in texts]


def test_round_trip_of_documents(spark):
    enc = tik()
    want = {}
    for r in table(spark, SF, "documents").collect():
        ids = enc.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256((r.text or "").encode()).hexdigest())
    got = {r[0]: tuple(r[1:]) for r in byte_bpe.op2_byte_bpe(spark, SF).collect()}
    assert got == want


CLASH = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("id", T.StringType()),
    ("ids", T.StringType()), ("path", T.StringType()))])


def test_encode_then_decode_rows(spark):
    rows = [(i, t, "x", None, "p") for i, t in enumerate(NASTY)] + [(None, "dup", None, None, None)] * 2
    docs = spark.createDataFrame(rows, CLASH)
    enc = byte_bpe.encode(docs, RANKS, P.PATTERN)
    back = byte_bpe.decode(enc, RANKS, P.PATTERN).collect()
    assert sorted((str(r.id), bytes(r.bytes)) for r in back) == sorted(
        (str(r[0]), (r[1] or "").encode()) for r in rows)
    assert byte_bpe.encode(docs.limit(0), RANKS, P.PATTERN).collect() == []


@pytest.mark.parametrize("unknown", [50257, -1, 2**32 + 5])
def test_decode_fails_on_unknown_ids(spark, unknown):
    rows = spark.createDataFrame([(1, [0, 1]), (2, [0, unknown, 1]), (3, None)], "id long, ids array<long>")
    assert byte_bpe.decode(rows.where("id != 2"), RANKS, P.PATTERN).count() == 2
    with pytest.raises(Exception, match="1 ids are not in"):
        byte_bpe.decode(rows, RANKS, P.PATTERN).collect()


def test_token_files_of_documents(spark):
    full = Tokenizer.from_file(WORDS)
    start, want = 0, []
    for r in sorted(table(spark, SF, "documents").collect(), key=lambda r: r.doc_id):
        ids = full.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, token_files.op10_token_files(spark, SF).collect())) == want


def test_files_index_and_damage(spark, tmp_path):
    rows = [(i * 3 % 17, t, "x", None, "p") for i, t in enumerate(NASTY)] + [(None, "dup", None, None, None)] * 2
    docs = spark.createDataFrame(rows, CLASH).repartition(3)
    manifest = token_files.write_token_files(docs, WORDS, 2, out_dir=str(tmp_path / "out"))
    found = []
    for m in sorted(manifest.collect(), key=lambda m: m.part):
        records = list(token_files.read_file(m.path))
        assert m.n_docs == len(records) and m.n_tokens == sum(len(i) for _, i in records)
        assert m.first_token == sum(len(i) for _, i in found)
        for k in reversed(range(len(records))):
            key, ids = token_files.read_record(m.path, k)
            assert key == records[k][0] and ids.tolist() == records[k][1].tolist()
        found += records
    keys = [k for k, _ in found]
    assert keys[:2] == [None, None] and keys[2:] == sorted(keys[2:]) and len(keys) == len(rows)
    empty = token_files.write_token_files(docs.limit(0), WORDS, 2)
    assert token_files.read_token_files(empty, (T.StructType([T.StructField("n", T.LongType())]),
                                                lambda k, i, f: (len(i),))).collect() == []
    path = next(m.path for m in manifest.collect() if m.n_docs)
    raw = bytearray(open(path, "rb").read())
    raw[-6] ^= 1
    open(path, "wb").write(bytes(raw))
    with pytest.raises(ValueError, match="damaged"):
        list(token_files.read_file(path))


def test_masked_crc():
    assert token_files.masked_crc(b"") == 0xA282EAD8
    n = struct.pack("<Q", 5)
    assert token_files.masked_crc(n) != zlib.crc32(n)
