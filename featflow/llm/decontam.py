"""Benchmark decontamination with SimHashed item-sized windows.

A benchmark item of n words is looked for in windows of n words of every
document (in all of it, where it has fewer): each window gets a 64-bit SimHash of its five-word shingles, a
multi-index over the items' fingerprints proposes candidates, and the exact
weighted similarity of the shingles (weights are their counts: sum of minima
over sum of maxima) decides, from ``min_similarity`` on.

*Windows.*  A window that shares no shingle with any item of its size has
similarity zero to all of them, so only windows around shared shingles are
fingerprinted; that loses nothing, and clean text costs one hash look-up per
word.

*Multi-index.*  Fingerprints are cut into eight blocks.  If two differ in at
most ``radius`` bits, some block differs in at most ``radius // 8``, so looking
up every block value within that many bits proposes all fingerprints within the
radius.  Each distance is then checked on all bits.  The radius holds for nearly
all similar windows, not for all (items of a short period have few distinct
shingles, and their fingerprints differ widely), so a window that shares enough
shingles with an item to reach ``min_similarity`` is a candidate at any distance.

*Size.*  Items are cut into blocks of at most ``BLOCK_BYTES`` of text (their
total is measured first) and each block is broadcast for one pass over the
documents, so nothing broadcast grows with the benchmark.

Defined results: items and documents of fewer than five words have no shingle
and never match; null texts are empty; letters A-Z count as lower case; a
document shorter than an item is one window as a whole; per row of ``docs`` and
item the most similar window is reported, the first of equals;
repeated rows of ``docs`` are all reported, repeated items count once; an empty table on either side gives none.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featflow.llm.common import (id_and_text, pieces, prefix_offsets, ragged_take, ready, schema,
                                 split_words, table, text_bytes)

SHINGLE = 5
#: Bits in which a similar window's fingerprint may differ from the item's.
RADIUS = 23
BLOCKS = 8
#: Text of the items that are broadcast for one pass.
BLOCK_BYTES = 8 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)


def word_hashes(words: pa.Array, seed: int = 0) -> np.ndarray:
    coded = words.dictionary_encode()
    h = xxhash.xxh64_intdigest
    known = coded.dictionary.to_pylist()
    return np.fromiter(map(h, known, repeat(seed)), np.uint64, len(known))[
        coded.indices.to_numpy(zero_copy_only=False)]


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """64-bit hash of every five words in a row."""
    n = len(words) - SHINGLE + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n].copy()
    for i in range(1, SHINGLE):
        out *= _P
        out += words[i:i + n]
    out ^= out >> np.uint64(29)
    out *= _Q
    out ^= out >> np.uint64(32)
    return out


def window_fingerprints(shingles: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """SimHash of ``shingles[s:s + n]`` for ascending ``starts``: a bit is set if
    over half of the shingles have it."""
    out = np.empty(len(starts), np.uint64)
    span = 1 << 14
    at = 0
    while at < len(starts):  # stretches of bounded length, for long documents
        low = int(starts[at])
        to = int(np.searchsorted(starts, low + span))
        bits = np.unpackbits(shingles[low:int(starts[to - 1]) + n].view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        total = np.zeros((len(bits) + 1, 64), np.int32)
        np.cumsum(bits, axis=0, out=total[1:])
        here = starts[at:to] - low
        more = 2 * (total[here + n] - total[here]) > n
        out[at:to] = np.packbits(more, axis=1, bitorder="little").view(np.uint64)[:, 0]
        at = to
    return out


class MultiIndex:
    """All stored fingerprints within ``radius`` bits of a query."""

    def __init__(self, fps: np.ndarray, radius: int = RADIUS, blocks: int = BLOCKS):
        self.fps, self.radius, self.width = fps, radius, 64 // blocks
        near = radius // blocks
        values = np.arange(1 << self.width, dtype=np.uint64)
        self.lists = []
        for b in range(blocks):
            own = fps >> np.uint64(b * self.width) & np.uint64((1 << self.width) - 1)
            close = np.bitwise_count(values[:, None] ^ own[None, :]) <= near
            value, item = np.nonzero(close)
            self.lists.append((np.searchsorted(value, np.arange(len(values) + 1)), item))

    def query(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, stored, distance) of every pair within the radius."""
        pairs = []
        for b, (bounds, item) in enumerate(self.lists):
            value = (fps >> np.uint64(b * self.width) & np.uint64((1 << self.width) - 1)
                     ).astype(np.int64)
            n = bounds[value + 1] - bounds[value]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            at = np.arange(total) + np.repeat(bounds[value] - (ends - n), n)
            pairs.append(np.repeat(np.arange(len(fps)), n) * len(self.fps) + item[at])
        both = np.unique(np.concatenate(pairs))
        q, s = both // len(self.fps), both % len(self.fps)
        d = np.bitwise_count(fps[q] ^ self.fps[s])
        ok = d <= self.radius
        return q[ok], s[ok], d[ok]


def _shingle_counts(words: list[bytes]) -> Counter:
    return Counter(zip(*[words[i:] for i in range(SHINGLE)]))


def similarity(a: Counter, b: Counter) -> float:
    common = sum(min(n, b[s]) for s, n in a.items() if s in b)
    total = a.total() + b.total() - common
    return common / total if total else 0.0


class ItemIndex:
    """Items of one block: shingle table for the windows, multi-index per size."""

    def __init__(self, items: list[tuple[object, str]], radius: int, min_similarity: float):
        self.min_similarity = min_similarity
        col = pa.array([t for _, t in items], pa.string())
        data, offsets = text_bytes(col)
        words, bounds, _, _ = split_words(_LOWER[data], offsets)
        hashed = word_hashes(words) if len(words) else np.empty(0, np.uint64)
        texts = words.to_pylist()
        self.ids, self.sizes, self.counts = [], [], []
        keys, owners, by_size = [], [], {}
        for i, (item_id, _) in enumerate(items):
            a, b = bounds[i], bounds[i + 1]
            if b - a < SHINGLE:
                continue
            k = len(self.ids)
            s = shingle_hashes(hashed[a:b])
            self.ids.append(item_id)
            self.sizes.append(len(s))
            self.counts.append(_shingle_counts(texts[a:b]))
            keys.append(s)
            owners.append(np.full(len(s), len(s)))
            by_size.setdefault(len(s), []).append(
                (k, window_fingerprints(s, np.zeros(1, np.int64), len(s))[0]))
        shingles_of = keys
        keys = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        owners = np.concatenate(owners) if owners else np.empty(0, np.int64)
        pairs = np.unique(np.rec.fromarrays([keys, owners], names="k,n")) if len(keys) else None
        self.keys = pairs["k"] if pairs is not None else keys
        self.key_sizes = pairs["n"] if pairs is not None else owners
        self.gate = np.zeros(1 << 22, bool)
        self.gate[(self.keys >> np.uint64(42)).astype(np.int64)] = True
        self.shared = {}  # by size: shingles in order and the item (within its size) of each
        for n, v in by_size.items():
            own = [np.unique(shingles_of[k]) for k, _ in v]
            key, item = np.concatenate(own), np.repeat(np.arange(len(own)), list(map(len, own)))
            order = np.argsort(key, kind="stable")
            self.shared[n] = key[order], item[order]
        self.by_size = {n: (np.array([k for k, _ in v]),
                            MultiIndex(np.array([f for _, f in v], np.uint64), radius))
                        for n, v in by_size.items()}

    def _beyond(self, k: int, m: int, at: np.ndarray, shingles: np.ndarray,
                starts: np.ndarray, fps: np.ndarray):
        """(window, item, distance) of pairs outside the radius that share enough
        shingles to reach the similarity: ``m`` shingles from each of ``starts`` on
        against items of ``k``; ``at`` are the places of shingles of such items."""
        index, (keys, owners) = self.by_size[k][1], self.shared[k]
        common = np.arange(1, min(m, k) + 1)
        enough = common[common / (m + k - common) >= self.min_similarity]
        first = np.searchsorted(at, starts)
        last = np.searchsorted(at, starts + m)
        rows = np.flatnonzero(last - first >= enough[0]) if len(enough) else enough
        if not len(rows):
            return
        base = first[rows[0]]
        first, n = first[rows] - base, (last - first)[rows]
        places = shingles[at[base:last[rows[-1]]]]
        low = np.searchsorted(keys, places)
        width = np.searchsorted(keys, places, side="right") - low
        upto = prefix_offsets(width)
        size = np.cumsum(upto[first + n] - upto[first])
        cut = 0
        while cut < len(rows):  # windows whose lists have a bounded length together
            done = size[cut - 1] if cut else 0
            to = max(cut + 1, int(np.searchsorted(size, done + (1 << 20), side="right")))
            place = ragged_take(np.arange(len(places)), first[cut:to], n[cut:to])
            q = np.repeat(np.repeat(rows[cut:to], n[cut:to]), width[place])
            both, count = np.unique(q * len(index.fps) + ragged_take(owners, low[place], width[place]),
                                    return_counts=True)
            both = both[count >= enough[0]]
            q, s = both // len(index.fps), both % len(index.fps)
            d = np.bitwise_count(fps[q] ^ index.fps[s])
            far = d > index.radius
            yield q[far], s[far], d[far]
            cut = to

    def search(self, col: pa.Array) -> list[tuple[int, int, int, int, int, float]]:
        """(text, item, first word, words, distance, similarity), the best
        window per text and item, for a string column."""
        if not len(self.keys):
            return []
        data, offsets = text_bytes(col)
        words, bounds, _, _ = split_words(_LOWER[data], offsets)
        if len(words) < SHINGLE:
            return []
        shingles = shingle_hashes(word_hashes(words))
        maybe = np.flatnonzero(self.gate[(shingles >> np.uint64(42)).astype(np.int64)])
        first = np.searchsorted(self.keys, shingles[maybe])
        last = np.searchsorted(self.keys, shingles[maybe], side="right")
        shared = last > first
        spots, first, last = maybe[shared], first[shared], last[shared]
        if not len(spots):
            return []
        # One row per shared shingle and window size it calls for.
        n = last - first
        ends = np.cumsum(n)
        size = self.key_sizes[np.arange(int(ends[-1])) + np.repeat(first - (ends - n), n)]
        spot = np.repeat(spots, n)
        text_of = np.searchsorted(bounds, spot, side="right") - 1
        best: dict[tuple[int, int], tuple] = {}
        for k in np.unique(size).tolist():
            at, owner = spot[size == k], text_of[size == k]
            low = np.maximum(at - k + 1, bounds[owner])
            high = np.minimum(at, bounds[owner + 1] - SHINGLE + 1 - k)  # last start
            total = bounds[owner + 1] - bounds[owner] - SHINGLE + 1  # shingles of the text
            # A text shorter than the item is a window itself, unless its length
            # alone keeps it below the bound.
            short = np.unique(owner[(total < k) & (total / k >= self.min_similarity)
                                    & (at + SHINGLE <= bounds[owner + 1])])
            length = bounds[short + 1] - bounds[short] - SHINGLE + 1
            windows = [(m, bounds[short[length == m]], short[length == m])
                       for m in np.unique(length).tolist()]
            ok = high >= low
            low, high, owner = low[ok], high[ok], owner[ok]
            if len(low):
                # Union of the ranges, as both ends ascend.
                low = np.maximum(low, np.concatenate([[0], high[:-1] + 1]))
                n = np.maximum(high - low + 1, 0)
                ends = np.cumsum(n)
                starts = np.arange(int(ends[-1])) + np.repeat(low - (ends - n), n)
                windows.append((k, starts, np.repeat(owner, n)))
            items, index = self.by_size[k]
            for m, starts, text in windows:
                for part in range(0, len(starts), 1 << 15):
                    some = starts[part:part + (1 << 15)]
                    fps = window_fingerprints(shingles, some, m)
                    found = [index.query(fps), *self._beyond(k, m, at, shingles, some, fps)]
                    for q, s, d in zip(*map(np.concatenate, zip(*found))):
                        start, item = int(some[q]), int(items[s])
                        window = words[start:start + m + SHINGLE - 1].to_pylist()
                        sim = similarity(_shingle_counts(window), self.counts[item])
                        if sim < self.min_similarity:
                            continue
                        t = int(text[part + q])
                        old = best.get((t, item))
                        if old is None or (-sim, start) < (-old[5], old[2]):
                            best[t, item] = (t, item, start, m + SHINGLE - 1, int(d), sim)
        return [(t, i, start - int(bounds[t]), n, d, sim)
                for t, i, start, n, d, sim in best.values()]


def _blocks(items: DataFrame, id_col: str, text_col: str):
    """The items, a block of at most about ``BLOCK_BYTES`` of text at a time."""
    src = id_and_text(items, id_col, text_col).where("text IS NOT NULL").distinct()
    total = src.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = -(-total // BLOCK_BYTES)
    for k in range(blocks):
        part = src.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k) if blocks > 1 else src
        yield [(r["id"], r["text"]) for r in part.orderBy("id", "text").collect()]


_INDEXES: dict[tuple, ItemIndex] = {}


def _index(shared, radius: int, min_similarity: float) -> ItemIndex:
    key = (hash(tuple(shared.value)), radius, min_similarity)
    if key not in _INDEXES:
        _INDEXES.clear()  # one block at a time
        _INDEXES[key] = ItemIndex(shared.value, radius, min_similarity)
    return _INDEXES[key]


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", radius: int = RADIUS,
                       min_similarity: float = 0.8) -> DataFrame:
    """``id``, ``item``, ``start_word``, ``n_words``, ``distance`` (bits) and
    ``similarity`` of the best window per row of ``docs`` and item."""
    spark = ready(docs.sparkSession)
    src = id_and_text(docs, id_col, text_col)
    item_type = items.schema[item_col].dataType
    out = schema(("id", src.schema["id"].dataType), ("item", item_type),
                 ("start_word", T.LongType()), ("n_words", T.LongType()),
                 ("distance", T.IntegerType()), ("similarity", T.DoubleType()))

    def search_with(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_type
            index = _index(shared, radius, min_similarity)
            kinds = [to_arrow_type(f.dataType) for f in out.fields]
            for b in pieces(batches):
                found = index.search(b.column("text"))
                if found:
                    t, i, start, n, d, sim = zip(*found)
                    ids = b.column("id").take(pa.array(t, pa.int64()))
                    rest = [[index.ids[k] for k in i], start, n, d, sim]
                    yield pa.RecordBatch.from_arrays(
                        [ids, *[pa.array(c, k) for c, k in zip(rest, kinds[1:])]],
                        out.fieldNames())
        return run

    found = None
    for block in _blocks(items, item_col, item_text_col):
        part = src.mapInArrow(search_with(spark.sparkContext.broadcast(block)), out)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], out)


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text",
                      radius: int = RADIUS, min_similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no item, with exactly their columns."""
    spark = ready(docs.sparkSession)

    def clean_with(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(shared, radius, min_similarity)
            for b in pieces(batches, text_col):
                hit = {f[0] for f in index.search(b.column(text_col))}
                yield b.filter(pa.array([i not in hit for i in range(b.num_rows)])) if hit else b
        return run

    for block in _blocks(items, item_col, item_text_col):
        docs = docs.mapInArrow(clean_with(spark.sparkContext.broadcast(block)), docs.schema)
    return docs


def op4_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage in every whole document."""
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "start_word",
                        "n_words", "similarity")


SQL_OP4 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM benchmark),
ds AS (SELECT doc_id, len(ws) - 4 AS total, p - 1 AS p, array_to_string(ws[p:p+4], ' ') AS s
       FROM (SELECT *, unnest(range(1, len(ws) - 3)) AS p FROM d WHERE len(ws) >= 5)),
bs AS (SELECT item_id, n, array_to_string(ws[p:p+4], ' ') AS s FROM
       (SELECT *, len(ws) - 4 AS n, unnest(range(1, len(ws) - 3)) AS p FROM b WHERE len(ws) >= 5)),
ic AS (SELECT item_id, n, s, count(*) AS c FROM bs GROUP BY ALL),
hit AS (SELECT DISTINCT doc_id, item_id, n, total, p FROM ds JOIN ic USING (s)),
win AS (SELECT DISTINCT doc_id, item_id, n, start FROM
        (SELECT *, unnest(range(greatest(p - n + 1, 0), least(p, total - n) + 1)) AS start FROM hit)),
wc AS (SELECT w.doc_id, w.item_id, w.n, w.start, ds.s, count(*) AS c
       FROM win w JOIN ds ON ds.doc_id = w.doc_id AND ds.p >= w.start AND ds.p < w.start + w.n
       GROUP BY ALL),
sim AS (SELECT wc.doc_id, wc.item_id, wc.n, wc.start, sum(least(wc.c, ic.c))::BIGINT AS common
        FROM wc JOIN ic ON ic.item_id = wc.item_id AND ic.s = wc.s GROUP BY ALL),
r AS (SELECT *, common::DOUBLE / (2 * n - common)::DOUBLE AS similarity FROM sim)
SELECT doc_id, item_id, start::BIGINT AS start_word, (n + 4)::BIGINT AS n_words, similarity
FROM r WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""
