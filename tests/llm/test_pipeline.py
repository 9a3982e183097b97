"""The pipeline against a plain Python version of the same decisions."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from featflow.llm import decontam, secret_scan
from featflow.llm.byte_bpe import parse_ranks
from featflow.llm.common import table
from tests.llm.test_decontam import brute as brute_contaminated
from tests.llm.test_quality import brute as brute_measures
from tests.llm.test_simhash import brute_components, brute_fingerprint


def expected(docs, items):
    measured = {}
    hosts = defaultdict(list)
    for r in docs:
        n, chars, sym, dup, rep, lines = brute_measures(r.text)
        base = n < 10 or 100 * rep > 20 * n
        excess = max(10 * sym / n, 2 * dup / lines, chars / (15 * n), 2 * n / chars) if n else 0
        measured[r.doc_id] = base, excess
        hosts[r.source].append(base or excess > 1)
    total = sum(map(len, hosts.values()))
    mean = sum(map(sum, hosts.values())) / total
    rates = np.array([sum(v) / len(v) for v in hosts.values()])
    extra = rates.var() - mean * (1 - mean) * np.mean([1 / len(v) for v in hosts.values()])
    k = min(max(mean * (1 - mean) / extra - 1, 1.0), 1e6) if extra > 0 else 1e6
    limits = {}
    for h, v in hosts.items():
        rate = (sum(v) + mean * k) / (len(v) + k)
        tail = 2 * (rate * (1 - rate) / (len(v) + k + 1)) ** 0.5
        limits[h] = 3 if rate + tail < mean else 0.75 if rate - tail > mean else 1
    docs = [r for r in docs if not measured[r.doc_id][0] and measured[r.doc_id][1] <= limits[r.source]]
    comp = brute_components({r.doc_id: brute_fingerprint(r.text) for r in docs}, 2)
    docs = [r for r in docs if comp[r.doc_id] == r.doc_id]
    shingles = {s for _, t in items for s in decontam._shingle_counts((t or "").encode().lower().split())}
    suspects = [(r.doc_id, r.text) for r in docs
                if shingles & set(decontam._shingle_counts((r.text or "").encode().lower().split()))]
    hit = {d for d, _ in brute_contaminated(suspects, items)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={}, mergeable_ranks=parse_ranks(
        open(P.path("byte_bpe_50k.tiktoken"), "rb").read()))
    out = []
    for r in docs:
        if r.doc_id in hit:
            continue
        text, at, clean = r.text, 0, ""
        for _, a, b in secret_scan.scan(text.encode()):
            if a >= at:
                clean += text[at:a] + "[SECRET]"
            at = max(at, b)
        clean += text[at:]
        ids = enc.encode_ordinary(clean)
        out.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(clean.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_equals_plain_version(spark, sf):
    docs = table(spark, sf, "documents").collect()
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    got = sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()))
    assert got == expected(docs, items)
    assert 0 < len(got) < len(docs)


def test_stages_keep_the_columns(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp string, root int"
    docs = spark.createDataFrame([(1, None, None, None, None, None, None), (2, "", "en", "s", 0, "f", 1),
                                  (3, "w " * 10, "en", "s", 20, "f", 1), (3, "w " * 10, "en", "s", 20, "f", 1),
                                  (4, " ".join(f"w{i}" for i in range(30_000)), "en", "s", 9, "f", 1)], schema)
    for frame in (docs, docs.limit(0)):
        cur = frame
        for _, step in corpus_pipeline.STAGES[:-1]:
            cur = step(spark, cur, "/root/testdata/sf0.001")
            assert cur.schema.names == docs.schema.names
            assert [f.dataType for f in cur.schema] == [f.dataType for f in docs.schema]
        last = corpus_pipeline.STAGES[-1][1](spark, cur, "/root/testdata/sf0.001").collect()
        assert [r.doc_id for r in last] == ([4] if frame is docs else [])
    assert re.fullmatch("[0-9a-f]{64}", hashlib.sha256(b"").hexdigest())
