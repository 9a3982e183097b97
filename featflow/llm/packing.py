"""Packing documents into training sequences by cutting-stock column generation.

A document of n tokens gives n // capacity full sequences and a remainder of
1 to capacity - 1 tokens.  The remainders' length histogram (at most
capacity - 1 numbers, however large the corpus) is a cutting-stock problem:

* a linear program over patterns (how many remainders of which length share a
  sequence) is solved by column generation; a knapsack dynamic program over the
  duals prices new patterns, until the bound of the duals says that the optimum
  is within ``tolerance``;
* the solution is rounded down; what is left over (less than one sequence per
  length) and the holes of patterns that don't fill a sequence are matched:
  documents left over are cut along the holes, then into sequences of their own.
  The last tokens make sequences of powers of two, which need no padding.

Assignment.  Documents of one length are alike, so a document's place follows
from its length and its rank among the documents of that length, in closed
form: a rank range of each length belongs to each pattern, and the ranks behind
them lie on a line of leftover tokens whose every position has its sequence.
Ranks need no sort: tokenizing numbers each task's documents by length, and a
prefix sum over the tasks' counts gives the base to add.  Only these counts (a
row per task and length) are grouped and shuffled; they are joined to the staged
documents on task and length, broadcast by Spark if they are small.

Memory: tasks hold a piece of the input; the driver holds the histogram and the
patterns, both bounded by the capacity (at most ``MAX_CAPACITY``).  Tokenized
documents are staged in the shared folder, so a lost executor repeats only its
own tasks, and ranks don't change when one is repeated.

Defined results: a null text is empty and has only its end id; null and
repeated keys are documents like all others; an empty table gives no rows;
other columns are ignored, whatever their names; long texts are encoded whole.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featflow.llm.common import (USUAL_PATTERN, WordMemory, id_and_text, pieces, prefix_offsets,
                                 ragged_take, ready, schema, split_units, stage, table,
                                 text_bytes, tokenizer_path, vocabulary)

#: Largest sequence length: the linear program's basis has its square of numbers.
MAX_CAPACITY = 4096


# --- patterns: column generation --------------------------------------------

def price(values: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the most valuable pattern and
    its value (counts per entry of ``lengths``)."""
    worth = np.full(capacity + 1, -np.inf)
    worth[lengths] = values
    best = np.zeros(capacity + 1)
    took = np.zeros(capacity + 1, np.int64)  # length put last, 0: one token of hole
    top = int(lengths.max())
    for c in range(1, capacity + 1):
        k = min(c, top)
        with_item = worth[1:k + 1] + best[c - k:c][::-1]
        i = int(with_item.argmax())
        if with_item[i] > best[c - 1] + 1e-12:
            best[c], took[c] = with_item[i], i + 1
        else:
            best[c] = best[c - 1]
    counts = np.zeros(capacity + 1, np.int64)
    c = capacity
    while c > 0:
        counts[took[c]] += 1
        c -= took[c] or 1
    return float(best[capacity]), counts[lengths]


def inverse_of(matrix: np.ndarray) -> np.ndarray:
    """Inverse by Gauss-Jordan steps (no threaded library: its threads do not
    survive the fork that starts a Spark session)."""
    n = len(matrix)
    work, out = matrix.astype(float), np.eye(n)
    for c in range(n):
        p = c + int(np.abs(work[c:, c]).argmax())
        if p != c:
            work[[c, p]], out[[c, p]] = work[[p, c]], out[[p, c]]
        out[c] /= work[c, c]
        work[c] /= work[c, c]
        rows = np.flatnonzero(work[:, c])
        rows = rows[rows != c]
        factor = work[rows, c][:, None]
        out[rows] -= factor * out[c]
        work[rows] -= factor * work[c]
    return out


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return (matrix * vector).sum(axis=1)


def greedy_basis(lengths: np.ndarray, demand: np.ndarray,
                 capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (and how often each) of a basic solution to start from: the longest length left is
    filled up with the longest that fit, as often as the first of them lasts.

    Each pattern uses up a length that later ones don't have, so the rows are
    linearly independent; lengths used up together get one of their own.
    """
    left = demand.astype(float)
    rows: list[np.ndarray] = []
    often: list[float] = []
    while (open_ := np.flatnonzero(left > 0)).size:
        counts, room = np.zeros(len(lengths), np.int64), capacity
        for c in open_[::-1]:
            if room < lengths[open_[0]]:
                break
            counts[c] = min(room // lengths[c], max(1, int(left[c])))
            room -= int(counts[c] * lengths[c])
        inside = np.flatnonzero(counts)
        times = left[inside] / counts[inside]
        left[inside] -= times.min() * counts[inside]
        gone = inside[(times <= times.min() * (1 + 1e-12)) | (left[inside] < 1e-9)]
        left[gone] = 0
        rows.append(counts)
        often.append(float(times.min()))
        for c in gone[1:]:
            often.append(0.0)
            alone = np.zeros(len(lengths), np.int64)
            alone[c] = capacity // lengths[c]
            rows.append(alone)
    return np.array(rows), np.array(often)


def solve_patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int,
                   tolerance: float = 0.002, rounds: int = 2_000):
    """Cutting-stock linear program: (patterns as rows, how often each, bound).

    Revised simplex from a greedy solution; ``bound`` is a lower bound on the
    number of sequences (from the duals, at first from the tokens alone), and
    the solution is within ``tolerance`` of it, unless ``rounds`` end first.
    """
    patterns, x = greedy_basis(lengths, demand, capacity)
    inverse = None
    bound = float((lengths * demand).sum()) / capacity
    for step in range(rounds):
        if x.sum() <= bound * (1 + tolerance):
            break
        if inverse is None:
            inverse = inverse_of(patterns.T)
        duals = inverse.sum(axis=0)  # each pattern costs one sequence
        value, pattern = price(duals, lengths, capacity)
        bound = max(bound, float((duals * demand).sum()) / max(value, 1.0))
        if value <= 1 + 1e-9:
            break
        direction = _times(inverse, pattern)
        ratio = np.where(direction > 1e-9, x / np.where(direction > 1e-9, direction, 1.0), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        patterns[out] = pattern
        if step % 400 == 399:  # afresh, against rounding errors
            inverse = inverse_of(patterns.T)
        else:
            row = inverse[out] / direction[out]
            direction[out] = 0.0
            inverse -= np.outer(direction, row)
            inverse[out] = row
        x = np.maximum(_times(inverse, demand), 0.0)
    return patterns, x, bound


@dataclass
class Plan:
    """Where every (length, rank) goes; all arrays are bounded by the capacity.

    ``used``, ``line``: per length, the ranks that patterns take, and where the
    others begin on the line of leftover tokens.  ``ranges``: per length, the
    patterns' (first rank, documents a sequence, first sequence, offset).
    ``holes``: (position on the line, first sequence, hole, offset) arrays.
    """
    capacity: int
    used: np.ndarray
    line: np.ndarray
    ranges: dict[int, tuple[np.ndarray, ...]]
    holes: tuple[np.ndarray, ...]
    hole_tokens: int
    packed: int  # sequences made of patterns
    whole: int  # sequences cut from the rest of the line
    tail: np.ndarray  # positions behind them where the last sequences begin
    bound: float

    @property
    def sequences(self) -> int:
        """Sequences before those of full pieces."""
        return self.packed + self.whole + len(self.tail)

    def place(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """(sequence, offset, tokens) of a remainder's pieces, in order."""
        if rank < self.used[length]:
            first, per, seq, offset = self.ranges[length]
            j = int(np.searchsorted(first, rank, side="right")) - 1
            copy, slot = divmod(rank - int(first[j]), int(per[j]))
            return [(int(seq[j]) + copy, int(offset[j]) + slot * length, length)]
        out = []
        at = int(self.line[length]) + (rank - int(self.used[length])) * length
        while length:
            seq, offset, room = self._position(at)
            n = min(room, length)
            out.append((seq, offset, n))
            at += n
            length -= n
        return out

    def _position(self, at: int) -> tuple[int, int, int]:
        """(sequence, offset, room from there) of a position of the line."""
        if at < self.hole_tokens:
            begin, seq, hole, offset = self.holes
            j = int(np.searchsorted(begin, at, side="right")) - 1
            copy, o = divmod(at - int(begin[j]), int(hole[j]))
            return int(seq[j]) + copy, int(offset[j]) + o, int(hole[j]) - o
        copy, o = divmod(at - self.hole_tokens, self.capacity)
        if copy < self.whole:
            return self.packed + copy, o, self.capacity - o
        j = int(np.searchsorted(self.tail, o, side="right")) - 1
        o -= int(self.tail[j])
        room = (int(self.tail[j + 1]) if j + 1 < len(self.tail) else self.capacity)
        return self.packed + self.whole + j, o, room - int(self.tail[j]) - o


def make_plan(histogram: np.ndarray, capacity: int, tolerance: float = 0.002) -> Plan:
    """Plan for ``histogram[i]`` remainders of i tokens (i below the capacity)."""
    histogram = np.asarray(histogram, np.int64)
    lengths = np.flatnonzero(histogram)
    demand = histogram[lengths]
    if len(lengths):
        patterns, x, bound = solve_patterns(lengths, demand, capacity, tolerance)
        copies = np.floor(x + 1e-9).astype(np.int64)
    else:
        patterns, copies, bound = np.zeros((0, 0), np.int64), np.zeros(0, np.int64), 0.0
    for j in np.flatnonzero(copies):  # rounding errors must not use a document twice
        while ((copies @ patterns - demand) * (patterns[j] > 0) > 0).any():
            copies[j] -= 1
    fill = patterns @ lengths if len(lengths) else np.zeros(0, np.int64)
    hole = capacity - fill
    # Holes are filled by documents left over; where these don't suffice,
    # sequences with the largest holes are taken apart.
    lacking = int(copies @ hole - (demand.sum() and demand @ lengths) + copies @ fill)
    for j in np.argsort(-hole, kind="stable"):
        if lacking <= 0:
            break
        n = min(int(copies[j]), -(-lacking // capacity)) if hole[j] else 0
        copies[j] -= n
        lacking -= n * capacity
    keep = copies > 0
    patterns, copies, fill, hole = patterns[keep], copies[keep], fill[keep], hole[keep]
    first_seq = np.cumsum(copies) - copies

    used = np.zeros(capacity, np.int64)
    line = np.zeros(capacity, np.int64)
    ranges, at = {}, 0
    inside = np.cumsum(patterns * lengths, axis=1) - patterns * lengths
    for c, length in enumerate(lengths.tolist()):
        mine = np.flatnonzero(patterns[:, c])
        docs = patterns[mine, c] * copies[mine]
        ranges[length] = (np.cumsum(docs) - docs, patterns[mine, c], first_seq[mine],
                          inside[mine, c])
        used[length], line[length] = docs.sum(), at
        at += length * int(histogram[length] - docs.sum())
    open_ = np.flatnonzero(hole)
    tokens = copies[open_] * hole[open_]
    holes = (np.cumsum(tokens) - tokens, first_seq[open_], hole[open_], fill[open_])
    whole, rest = divmod(at - int(tokens.sum()), capacity)
    powers = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return Plan(capacity, used, line, ranges, holes, int(tokens.sum()), int(copies.sum()), whole,
                prefix_offsets(powers)[:-1].astype(np.int64), bound)


# --- tokenizing -------------------------------------------------------------

class SegmentTokenizer:
    """Ids of texts under a byte-level BPE with the usual pattern.

    Texts are cut into units that begin a match of the pattern; units new to the
    worker are cut into matches, and new matches are tokenized many at a time by
    the tokenizer's model, without its pattern.
    """

    #: Matches joined to one call of the model.
    JOINED = 512

    def __init__(self, data: bytes):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.full = Tokenizer.from_str(data.decode())
        cutter = json.loads(data).get("pre_tokenizer") or {}
        if (cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space")
                or not cutter.get("use_regex", True)):
            raise ValueError("not a byte-level tokenizer with the usual pattern")
        self.special = tuple(t.content.encode() for t in self.full.get_added_tokens_decoder().values())
        self.bare = Tokenizer(self.full.model)
        self.bare.pre_tokenizer = WhitespaceSplit()
        self.letters = _byte_letters()
        vocab = self.full.get_vocab(with_added_tokens=False)
        self.size = np.zeros(max(vocab.values()) + 1, np.int64)  # bytes of each token
        self.size[list(vocab.values())] = list(map(len, vocab))
        self.find = regex.compile(USUAL_PATTERN).findall
        self.width = 2 if self.full.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype("<u2" if self.width == 2 else "<u4")
        self.memory = WordMemory()

    def _learn_matches(self, new: list[bytes]) -> None:
        chunks = [new[at:at + self.JOINED] for at in range(0, len(new), self.JOINED)]
        joined = [" ".join([x.decode("latin-1").translate(self.letters) for x in c]) for c in chunks]
        for some, e in zip(chunks, self.bare.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(e.ids, self.kind)
            ends = np.searchsorted(np.cumsum(self.size[ids]), np.cumsum(list(map(len, some)))) + 1
            raw, a = ids.tobytes(), 0
            for x, b in zip(some, (ends * self.width).tolist()):
                self.memory[x] = raw[a:b]
                a = b

    def _learn(self, units: list[bytes], special: tuple[bytes, ...]) -> None:
        memory, matches, cut = self.memory, [], []
        for u in memory.unknown(units):
            if special and any(s in u for s in special):
                ids = self.full.encode(u.decode(), add_special_tokens=False).ids
                memory[u] = np.array(ids, self.kind).tobytes()
            elif u.isascii() and b"'" not in u:
                matches.append(u)
            else:
                parts = [x.encode() for x in self.find(u.decode())]
                if len(parts) > 1:
                    cut.append((u, parts))
                matches += parts
        self._learn_matches(list(dict.fromkeys(memory.unknown(matches))))
        for u, parts in cut:
            memory[u] = b"".join([memory[x] for x in parts])

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, text offsets into them) of a string column."""
        data, offsets = text_bytes(col)
        raw = data.tobytes()
        special = tuple(s for s in self.special if s in raw)
        units, bounds = split_units(data, offsets, special)
        coded = units.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self.memory.begin()
        self._learn(distinct, special)
        found = self.memory.all(distinct)
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // self.width
        values = np.frombuffer(b"".join(found), self.kind)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        per_unit = lengths[codes]
        ids = ragged_take(values, (np.cumsum(lengths) - lengths)[codes], per_unit)
        return ids, prefix_offsets(per_unit)[bounds]


def _byte_letters() -> dict[int, str]:
    """The characters that byte-level vocabularies write bytes as: printable
    ones as themselves, the others as those from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(0x100 + i) for i, b in enumerate(others)}}


_TOKENIZERS: dict[int, SegmentTokenizer] = {}


def _tokenizer(shared) -> SegmentTokenizer:
    """One tokenizer (and its memory) per worker process and vocabulary."""
    key = zlib.crc32(shared.value)
    if key not in _TOKENIZERS:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _TOKENIZERS[key] = SegmentTokenizer(shared.value)
    return _TOKENIZERS[key]


# --- Spark ------------------------------------------------------------------

def tokenize(docs: DataFrame, tokenizer_file: str, end_id: int, capacity: int,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Staged rows: ``id``, ``ids`` (binary, ``width`` bytes each, end id last),
    ``n`` tokens, ``rest`` = n modulo capacity, and the row's numbers within its
    task ``part``: ``nth`` of its ``rest``, ``full`` pieces before it."""
    spark = ready(docs.sparkSession)
    shared = vocabulary(spark, tokenizer_file)
    src = id_and_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(shared)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], tok.kind).tobytes()
        seen, full = np.zeros(capacity, np.int64), 0
        for b in pieces(batches, limit=8 << 20):
            ids, bounds = tok.encode(b.column("text"))
            raw, cuts = ids.tobytes(), (bounds * tok.width).tolist()
            n = np.diff(bounds) + 1
            rest = n % capacity
            order = np.argsort(rest, kind="stable")
            ranked = rest[order]
            nth = np.empty(len(n), np.int64)
            nth[order] = np.arange(len(n)) - np.searchsorted(ranked, ranked) + seen[ranked]
            seen += np.bincount(rest, minlength=capacity)
            whole = n // capacity
            before = full + np.cumsum(whole) - whole
            full += int(whole.sum())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([raw[x:y] + end for x, y in zip(cuts, cuts[1:])],
                                          pa.binary()),
                 pa.array(np.full(len(n), tok.width, np.int32)), pa.array(n.astype(np.int64)),
                 pa.array(np.full(len(n), part, np.int32)), pa.array(rest.astype(np.int32)),
                 pa.array(nth), pa.array(before)],
                ["id", "ids", "width", "n", "part", "rest", "nth", "full"])

    out = schema(("id", src.schema["id"].dataType), ("ids", T.BinaryType()),
                 ("width", T.IntegerType()), ("n", T.LongType()), ("part", T.IntegerType()),
                 ("rest", T.IntegerType()), ("nth", T.LongType()), ("full", T.LongType()))
    return stage(spark, src.mapInArrow(run, out), "tokenized")


def task_bases(tokens: DataFrame, capacity: int) -> DataFrame:
    """Staged rows (``part``, ``rest``, ``docs``, ``base``, ``full_base``): how
    many documents of the length, and full pieces, the tasks before have."""
    counts = tokens.groupBy("part", "rest").agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum(F.floor(F.col("n") / capacity).cast("long")).alias("full"))
    # Full pieces are counted like one more length, -1.
    full = counts.groupBy("part").agg(F.sum("full").alias("docs"))
    rows = counts.select("part", "rest", "docs").unionByName(
        full.select("part", F.lit(-1).alias("rest"), "docs"))
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = rows.withColumn("base", F.coalesce(F.sum("docs").over(before), F.lit(0).cast("long")))
    based = stage(tokens.sparkSession, based, "task-bases")
    pieces_before = based.where("rest = -1").select("part", F.col("base").alias("full_base"))
    return based.where("rest >= 0").join(pieces_before, "part")


def pack(docs: DataFrame, tokenizer_file: str, end_id: int, capacity: int = 1024,
         id_col: str = "doc_id", text_col: str = "text", tolerance: float = 0.002) -> DataFrame:
    """A row per piece: ``id``, ``start`` (the document's ids before it), ``length``,
    ``ids`` (binary, little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id`` and ``offset`` in the sequence."""
    if not 2 <= capacity <= MAX_CAPACITY:
        raise ValueError(f"capacity must be 2 to {MAX_CAPACITY}")
    spark = docs.sparkSession
    tokens = tokenize(docs, tokenizer_file, end_id, capacity, id_col, text_col)
    bases = stage(spark, task_bases(tokens, capacity), "bases")
    histogram = np.zeros(capacity, np.int64)
    for r in bases.where("rest > 0").groupBy("rest").agg(F.sum("docs").alias("docs")).collect():
        histogram[r["rest"]] = r["docs"]  # at most ``capacity`` rows
    plan = make_plan(histogram, capacity, tolerance)
    shared = spark.sparkContext.broadcast(plan)
    placed = tokens.join(bases.select("part", "rest", "base", "full_base"), ["part", "rest"]).select(
        "id", "ids", "width", "n", "rest", (F.col("nth") + F.col("base")).alias("rank"),
        (F.col("full") + F.col("full_base")).alias("full"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        out = T.StructType(result.fields)
        for b in pieces(batches, "ids"):
            rows, at = [], []
            columns = [b.column(c).to_pylist() for c in ("ids", "width", "n", "rest", "rank", "full")]
            for i, (raw, width, n, rest, rank, full) in enumerate(zip(*columns)):
                ids = np.frombuffer(raw, "<u2" if width == 2 else "<u4").astype("<u4").tobytes()
                spots = [(plan.sequences + full + k, 0, capacity) for k in range(n // capacity)]
                if rest:
                    spots += plan.place(rest, rank)
                start = 0
                for seq, offset, length in spots:
                    rows.append((start, length, ids[4 * start:4 * (start + length)], n, seq, offset))
                    at.append(i)
                    start += length
            columns = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(at, pa.int64())),
                 *[pa.array(c, pa.binary() if name == "ids" else pa.int64())
                   for c, name in zip(columns, out.fieldNames()[1:])]], out.fieldNames())

    result = schema(("id", tokens.schema["id"].dataType), ("start", T.LongType()),
                    ("length", T.LongType()), ("ids", T.BinaryType()), ("doc_tokens", T.LongType()),
                    ("sequence_id", T.LongType()), ("offset", T.LongType()))
    return placed.mapInArrow(run, result)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack every whole document into sequences of 1,024 tokens."""
    made = pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0)
    return made.select(F.col("id").alias("doc_id"), "start", "length",
                       F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
