"""Repeated passages by a sparse suffix array.

A passage is at least ``min_words`` (50) words in a row that occur at two
places or more, in different documents or one.

1. *Sparse suffixes.*  Every window of 25 consecutive five-word shingles selects
   the position of its smallest shingle hash (the minimiser).  Any 50 words
   contain such a window, so two occurrences of a passage select the same
   positions; suffixes are kept there only (about one word in thirteen).
2. *Sort and compare neighbours.*  Suffixes are sorted over the cluster by the
   hash of their first 26 words (which every passage has from its minimiser on),
   then by the hash of the words around.  A suffix whose neighbour agrees on all 50-word windows that
   belong to it is repeated there as a whole.
3. *Windows.*  Where neighbours share the first 26 words only, no match is
   extended word by word: all 50-word windows around one representative of each
   context are hashed, sorted and compared in the same way.

Words are compared by two 64-bit hashes wherever rows are matched: prefix and
context of suffixes, two hashes with different seeds of windows.  Sorting is range partitioning on the whole sort key, position
included, so a passage that occurs in a third of all documents is spread over
many tasks; each task streams its rows and keeps one, and the rows at the
borders of the partitions (two per task) are filtered in parallel and moved to
one more task that compares them.
Documents with the same text are one document to the steps above (they sort
next to each other and collapse) and are expanded at the end.

Defined results: null texts are empty; texts of fewer than 50 words have no
span; white space does not count; repeated rows are copies of each other; an
empty table gives none; texts are read whole, however long; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featflow.llm.common import pieces, ready, schema, split_words, stage, table, text_bytes
from featflow.llm.decontam import shingle_hashes, word_hashes

MIN_WORDS = 50
_POS_BITS = np.uint64(28)
_BASE = 0x9E3779B97F4A7C15
#: Seed of the words' second hash.
_SECOND = 0xC2B2AE3D27D4EB4F
_INVERSE = pow(_BASE, -1, 1 << 64)


class RangeHash:
    """Hashes of word ranges [a, b) from one pass over the words' hashes."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        power = np.ones(n + 1, np.uint64)
        power[1:] = np.uint64(_BASE)
        self.back = np.ones(n + 1, np.uint64)
        self.back[1:] = np.uint64(_INVERSE)
        np.cumprod(power, out=power)
        np.cumprod(self.back, out=self.back)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * power[:n], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        h = (self.sums[b] - self.sums[a]) * self.back[a]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        return h


def minimisers(shingles: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of ``width`` shingles from each position on (the
    first of equals)."""
    n = len(shingles)
    low = (shingles >> _POS_BITS << _POS_BITS) | np.arange(n, dtype=np.uint64)
    have = 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:]) if len(low) > step else low[:0]
        have += step
    return (low & np.uint64((1 << int(_POS_BITS)) - 1)).astype(np.int64)


def _suffixes(min_words: int):
    width = (min_words + 1) // 2  # shingles per window
    prefix = min_words - width + 1  # words every passage has from its minimiser on

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            words, bounds, _, _ = split_words(*text_bytes(b.column("text")))
            n_words = np.diff(bounds)
            th = b.column("th").to_numpy(zero_copy_only=False)
            none = pa.nulls(b.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, pa.array(th), pa.array(n_words), none, none, b.column("id")], _NAMES)
            if not (n_words >= min_words).any():
                continue
            hashed = word_hashes(words)
            first = minimisers(shingle_hashes(hashed), width)
            # Starts of 50-word windows, with their minimiser; runs share one.
            length = np.maximum(n_words - min_words + 1, 0)
            ends = np.cumsum(length)
            start = np.arange(int(ends[-1])) + np.repeat(bounds[:-1] - (ends - length), length)
            spot = first[start]
            cut = np.flatnonzero(np.concatenate([[True], spot[1:] != spot[:-1]]))
            last = np.concatenate([cut[1:], [len(start)]]) - 1
            spot, low, high = spot[cut], start[cut], start[last]
            text = np.searchsorted(bounds, low, side="right") - 1
            ranges = RangeHash(hashed)
            around = ranges.of(low, high + min_words)
            around += ((spot - low) * 64 + (high - low)).astype(np.uint64) * np.uint64(_BASE)
            base = bounds[text]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranges.of(spot, spot + prefix).view(np.int64)),
                 pa.array(around.view(np.int64)), pa.array(th[text]),
                 pa.array(spot - base), pa.array(low - base), pa.array(high - base),
                 pa.nulls(len(spot), b.column("id").type)], _NAMES)

    return run


_NAMES = ["key", "ext", "th", "pos", "low", "high", "id"]
_SORT = ["key", "ext", "th", "pos"]
_LONG = [(n, T.LongType()) for n in _NAMES[:-1]]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition whose neighbours share their key.

    ``full``: a neighbour shares the context too; ``part``: one shares the key
    only; ``edge``: first or last row of the partition, whose other neighbour
    is elsewhere.  Equal rows are one.  Holds one batch and one row.
    """
    names = [*_SORT, "low", "high"]
    held = None  # the last row so far, with its flags from the row before
    full = part = False
    first = True

    def out(columns, full, part, edge):
        keep = full | part | edge
        return pa.RecordBatch.from_arrays(
            [pa.array(c[keep]) for c in columns]
            + [pa.array(f[keep]) for f in (full, part, edge)], [*names, "full", "part", "edge"])

    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(n).to_numpy(zero_copy_only=False) for n in names]
        if held is not None:
            cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
        key, ext, th, pos = cols[:4]
        fresh = np.ones(len(key), bool)
        fresh[1:] = ((key[1:] != key[:-1]) | (ext[1:] != ext[:-1]) | (th[1:] != th[:-1])
                     | (pos[1:] != pos[:-1]))
        cols = [c[fresh] for c in cols]
        key, ext = cols[:2]
        same_key = key[1:] == key[:-1]
        same = same_key & (ext[1:] == ext[:-1])
        f, p, e = (np.zeros(len(key), bool) for _ in range(3))
        f[0], p[0] = full, part
        f[1:] |= same
        f[:-1] |= same
        p[1:] |= same_key & ~same
        p[:-1] |= same_key & ~same
        e[0] = first
        held, full, part = [c[-1:] for c in cols], bool(f[-1]), bool(p[-1])
        if len(key) > 1:
            yield out([c[:-1] for c in cols], f[:-1], p[:-1], e[:-1])
            first = False
    if held is not None:
        yield out(held, np.array([full]), np.array([part]), np.array([True]))


def neighbours(rows: DataFrame) -> DataFrame:
    """Globally sorted neighbour comparison; rows need ``key``, ``ext``, ``th``,
    ``pos``, ``low`` and ``high``.  A row may come twice."""
    out = schema(*[(n, T.LongType()) for n in (*_SORT, "low", "high")],
                 *[(n, T.BooleanType()) for n in ("full", "part", "edge")])
    cols = [*_SORT, "low", "high"]
    placed = rows.select(*cols).repartitionByRange(*_SORT).sortWithinPartitions(*_SORT)
    marked = stage(rows.sparkSession, placed.mapInArrow(_compare, out), "neighbours")
    # Filtered where the rows lie; only the edge rows move to one task.
    borders = marked.where("edge").select(*cols).repartition(1).sortWithinPartitions(*_SORT)
    return marked.unionByName(borders.mapInArrow(_compare, out)).where("full OR part")


def _windows(min_words: int):
    """Two hashes of every 50-word window of the contexts listed with a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            words, bounds, _, _ = split_words(*text_bytes(b.column("text")))
            if not len(words):
                continue
            ranges, others = RangeHash(word_hashes(words)), RangeHash(word_hashes(words, _SECOND))
            starts, owner = [], []
            for i, spans in enumerate(b.column("spans").to_pylist()):
                found = np.unique(np.concatenate(
                    [np.arange(s["low"], s["high"] + 1) for s in spans]))
                starts.append(found + bounds[i])
                owner.append(np.full(len(found), i))
            start, text = np.concatenate(starts), np.concatenate(owner)
            at = pa.array(start - bounds[text])
            th = b.column("th").to_numpy(zero_copy_only=False)[text]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(r.of(start, start + min_words).view(np.int64)) for r in (ranges, others)),
                 pa.array(th), at, at, at], _NAMES[:-1])

    return run


def _merge(min_words: int):
    """Disjoint word spans from lists of window ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for th, spans in zip(b.column("th").to_pylist(), b.column("spans").to_pylist()):
                start = end = None
                for low, high in sorted((s["low"], s["high"]) for s in spans):
                    if end is not None and low <= end:
                        end = max(end, high + min_words)
                        continue
                    if end is not None:
                        out.append((th, start, end))
                    start, end = low, high + min_words
                out.append((th, start, end))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                 ["th", "start_word", "end_word"])

    return run


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_words: int = MIN_WORDS) -> DataFrame:
    """``id``, ``start_word``, ``end_word`` (exclusive) of every maximal stretch
    of words that is covered by repeated passages, for each row of ``docs``."""
    spark = ready(docs.sparkSession)
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(f"`{text_col}`", F.lit(""))
                      .alias("text")).withColumn("th", F.xxhash64("text"))
    kind = src.schema["id"].dataType
    found = stage(spark, src.mapInArrow(_suffixes(min_words), schema(*_LONG, ("id", kind))),
                  "suffixes")
    rows = found.where("key IS NULL").select("id", "th", F.col("pos").alias("n_words"))
    texts = rows.groupBy("th").agg(F.min("id").alias("id"), F.max("n_words").alias("n_words"),
                                   F.count(F.lit(1)).alias("copies"))

    marked = neighbours(found.where("key IS NOT NULL"))
    span = F.struct("low", "high")
    open_ = (marked.where("part").groupBy("th").agg(F.collect_set(span).alias("spans"))
             .join(texts.select("th", F.col("id").alias("rep")), "th"))
    # One copy of each text with an open context, by its id and text.
    read = src.join(open_, (src["th"] == open_["th"]) & src["id"].eqNullSafe(open_["rep"])).select(
        "text", src["th"], "spans")
    windows = stage(spark, read.mapInArrow(_windows(min_words), schema(*_LONG)), "windows")
    again = neighbours(windows).where("full")

    whole = texts.where((F.col("copies") > 1) & (F.col("n_words") >= min_words)).select(
        "th", F.lit(0).cast("long").alias("low"), (F.col("n_words") - min_words).alias("high"))
    ranges = (marked.where("full").select("th", "low", "high")
              .unionByName(again.select("th", "low", "high")).unionByName(whole))
    spans = (ranges.groupBy("th").agg(F.collect_set(span).alias("spans"))
             .mapInArrow(_merge(min_words), schema(("th", T.LongType()), ("start_word", T.LongType()),
                                                   ("end_word", T.LongType()))))
    return rows.select("id", "th").join(spans, "th").select("id", "start_word", "end_word")


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of 50 words or more that occur elsewhere, for every document."""
    found = repeated_passages(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "start_word", "end_word",
                        (F.col("end_word") - F.col("start_word")).alias("n_words"))


SQL_OP8 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, p - 1 AS p, md5(array_to_string(ws[p:p+49], ' ')) AS h FROM
      (SELECT *, unnest(range(1, len(ws) - 48)) AS p FROM d WHERE len(ws) >= 50)),
r AS (SELECT doc_id, p FROM g QUALIFY count(*) OVER (PARTITION BY h) > 1),
i AS (SELECT *, CASE WHEN p <= 50 + lag(p) OVER w THEN 0 ELSE 1 END AS fresh FROM r
      WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS island FROM i)
SELECT doc_id, min(p)::BIGINT AS start_word, (max(p) + 50)::BIGINT AS end_word,
       (max(p) + 50 - min(p))::BIGINT AS n_words
FROM n GROUP BY doc_id, island
"""
