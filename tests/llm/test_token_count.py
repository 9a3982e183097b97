import random

import public_tokenizers as P
import pyarrow as pa
import pytest

from featflow.llm import token_count as C
from featflow.llm.common import table

SF = "/root/testdata/sf0.001"
FILE = P.path("piece_bpe_32k.model")
rng = random.Random(2)
ALPHABET = "aAbZethionr09  .,'’-_<|>\n\té́̈ñßK　 ​日😀#\x1c\x85▁  \x00"
TEXTS = [None, "", "  ", "<s> </s> <unk> <0x41>", "a" * 2000, "日本語 テスト", "😀😀 x", "▁▁a▁b"] + [
    "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(50))) for _ in range(400)]


@pytest.fixture(scope="module")
def model():
    return C.Unigram.from_sentencepiece(open(FILE, "rb").read())


def lib_counts(model, texts):
    lib = model.library()
    return [len(lib.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_equals_library(model):
    tokens, score = C.Counter(model).count(pa.array(TEXTS, pa.string()))
    assert tokens.tolist() == lib_counts(model, TEXTS)
    assert score[1] == 0 and (score[4:] < 0).any()


@pytest.mark.parametrize("fallback", [False, True])
def test_ties_and_unknowns(fallback):
    bytes_ = [(f"<0x{b:02X}>", -99.0) for b in range(256)] if fallback else []
    pieces = [("<unk>", -99.0), (C.MARK, -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0),
              ("aab", -3.0), (C.MARK + "a", -2.0), ("abab", -4.0)] + bytes_
    model = C.Unigram(pieces, 0, fallback)
    texts = ["".join(rng.choice("abcé ") for _ in range(rng.randrange(14))) for _ in range(500)]
    tokens, _ = C.Counter(model).count(pa.array(texts))
    assert tokens.tolist() == lib_counts(model, texts)


def test_documents(spark, model):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = {r.doc_id: r.n_tokens for r in C.op9_token_count(spark, SF).collect()}
    assert got == dict(zip(docs, lib_counts(model, docs.values())))


def test_rows(spark):
    docs = spark.createDataFrame([(1, None, "a", 1.0), (2, "", "b", 2.0), (2, "", "b", 2.0), (None, "x y", None, None),
                                  (5, "long " * 50_000, "c", 0.0)],
                                 "doc_id long, text string, n_tokens string, score double")
    got = sorted((str(r.doc_id), r.n_tokens) for r in C.count_tokens(docs, FILE).collect())
    assert [g[0] for g in got] == ["1", "2", "2", "5", "None"] and [g[1] for g in got[:3]] == [0, 0, 0]
    assert got[3][1] % 50_000 == 0 and C.count_tokens(docs.limit(0), FILE).collect() == []
