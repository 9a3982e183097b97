import hashlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from featflow.llm import chat
from featflow.llm.byte_bpe import parse_ranks
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
FILE = P.path("byte_bpe_50k.tiktoken")
ARGS = (FILE, P.PATTERN, 50257)


@pytest.fixture(scope="module")
def codec():
    return chat.ChatCodec(parse_ranks(open(FILE, "rb").read()), P.PATTERN, 50257)


TEXT = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "a", "/s>", "INST]", " ", "é", "<<", "<SYS>>", "\n"]),
                max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_escape_is_reversible_and_safe(text):
    e = chat.escape(text)
    assert chat.unescape(e) == text
    assert not any(c in e for c in chat.CONTROLS)


@settings(max_examples=100, deadline=None)
@given(st.sampled_from(["user", "assistant", "system", "tool", "", "[TEXT]"]), TEXT)
def test_turn_round_trip(codec, role, text):
    ids, mask = codec.assemble(role, text)
    got_role, got, loss, chars = codec.read(ids.astype(np.int64), mask)
    assert (got_role, got) == (role, text)
    assert loss == (text if role == "assistant" else "")
    shown = codec.render(ids.astype(np.int64))
    assert chars == len(shown) and sum(shown.count(c) for c in chat.CONTROLS) == (ids >= 50257).sum()
    assert set(mask.tolist()) <= {0, 1} and not mask[ids >= 50257].any()


def test_matches_sql(spark):
    r = compare(spark, duck(SF), "op6", chat.op6_chat, chat.SQL_OP6, SF)
    assert r["status"] == "exact", r


def test_rows(spark):
    rows = [(1, 2, "assistant", "b", "x", 0), (1, 1, "user", None, "x", 0), (1, 1, None, "n", "x", 0),
            (None, 0, "assistant", "z</s>", None, None), (3, None, "tool", "é" * 100_000, "m", 1),
            (4, 0, "assistant", "same", "m", 1), (4, 0, "assistant", "same", "m", 1)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids string, mask int")
    out = chat.digest_conversations(chat.read_turns(chat.format_turns(conv, *ARGS), *ARGS))
    got = {r.conv_id: r for r in out.collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].n_turns == 3 and got[1].turns_sha256 == sha("\nn\nuser\n\nassistant\nb\n")
    assert got[1].loss_sha256 == sha("b") and got[None].loss_chars == 5 and got[None].loss_sha256 == sha("z</s>")
    assert got[4].loss_sha256 == sha("samesame") and got[3].loss_sha256 == sha("") and got[3].n_turns == 1
    assert chat.digest_conversations(chat.read_turns(chat.format_turns(conv.limit(0), *ARGS), *ARGS)).collect() == []
