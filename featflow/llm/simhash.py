"""SimHash near-duplicates by anchor-point covering.

Fingerprints are 64 bits.  Their low 46 bits are two 23-bit blocks, and in each
block the perfect binary Golay code serves as covering code: every block value
lies within three bits (the covering radius) of exactly one codeword.  The
*anchors* are the pairs of codewords, 2**24 of them.  A fingerprint's home is
its nearest anchor.  If two fingerprints differ in at most ``max_bits`` bits,
then the second lies within the covering radius plus ``max_bits`` of the
first's home, so each fingerprint is replicated to every such anchor (about 68
for two bits) and compared there with the fingerprints at home, on all 64 bits.
No link can be lost; the radius is kept per block, which is tighter than the
sum.

Links go to distributed connected components (alternating large-star and
small-star rounds, each written to shared storage).  Exact copies share a
fingerprint and enter as one vertex, so a group of copies of any size costs one
row per task.

Defined results: a null or empty text has no words and fingerprint zero; fewer
words than a shingle make one shingle; repeated rows are all returned; rows
with a null id get a class like any other (the class id is the smallest
non-null id, null if there is none); texts are read whole, however long; an empty
table gives an empty table; other columns are ignored, whatever their names
(``keep_one_per_class`` returns them as they are).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featflow.llm.common import (byte_texts, free_names, id_and_text, pieces, ready, schema, stage,
                                 table)

_SEED = 42
#: Home fingerprints compared at one place; a fuller anchor is split.
HOMES_PER_GROUP = 8192


# --- fingerprints -----------------------------------------------------------

def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of the word shingles (repeats count)."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    h = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter((h(p, _SEED) for p in parts), np.uint64, n)
    count = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        part = hashes[at:at + (1 << 15)]
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """``id``, ``fp`` (the 64 bits as a signed long) and ``th`` (hash of the
    text) of every row."""
    ready(docs.sparkSession)
    src = id_and_text(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            fps = np.array([fingerprint(t, shingle) for t in byte_texts(b)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(fps.view(np.int64)), b.column("th")], ["id", "fp", "th"])

    return src.mapInArrow(run, schema(("id", src.schema["id"].dataType), ("fp", T.LongType()),
                                      ("th", T.LongType())))


# --- the covering code ------------------------------------------------------

_BLOCK = 23
_CHECK = 11
_POLY = 0b101011100011  # generator of the [23, 12] Golay code


def _syndromes(values: np.ndarray) -> np.ndarray:
    rest = values.astype(np.int64)
    for bit in range(_BLOCK - 1, _CHECK - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (_POLY << (bit - _CHECK)), rest)
    return rest


class Covering:
    """Error patterns of the Golay code, by syndrome and by weight beyond the
    covering radius: ``patterns[k][syndrome]`` holds the patterns of weight 3+k
    (k > 0) or at most 3 (k = 0), padded with -1."""

    def __init__(self, max_bits: int):
        if not 0 <= max_bits <= 4:
            raise ValueError("max_bits must be between 0 and 4")
        self.max_bits = max_bits
        low = np.arange(1 << 12)
        self.low, self.high = _syndromes(low), _syndromes(low << 12 & (1 << _BLOCK) - 1)
        self.patterns = []
        for k in range(max_bits + 1):
            weights = range(4) if k == 0 else [3 + k]
            masks = np.array([sum(1 << i for i in c) for w in weights
                              for c in combinations(range(_BLOCK), w)], np.int64)
            syn = _syndromes(masks)
            order = np.argsort(syn, kind="stable")
            syn, masks = syn[order], masks[order]
            rank = np.arange(len(syn)) - np.searchsorted(syn, syn)
            padded = np.full((1 << _CHECK, rank.max() + 1), -1, np.int64)
            padded[syn, rank] = masks
            self.patterns.append(padded)

    def anchors(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, index into ``fps``, is home) of every replica."""
        mask = (1 << _BLOCK) - 1
        blocks = [(fps & np.uint64(mask)).astype(np.int64),
                  (fps >> np.uint64(_BLOCK) & np.uint64(mask)).astype(np.int64)]
        words = []  # by block and excess: codeword number of each pattern, -1 for none
        for value in blocks:
            syn = self.low[value & 0xFFF] ^ self.high[value >> 12]
            words.append([np.where(p[syn] < 0, -1, (value[:, None] ^ p[syn]) >> _CHECK)
                          for p in self.patterns])
        out_a, out_i, out_h = [], [], []
        for i in range(self.max_bits + 1):
            for j in range(self.max_bits + 1 - i):
                a, b = words[0][i][:, :, None], words[1][j][:, None, :]
                both = np.where((a < 0) | (b < 0), -1, a << 12 | b).reshape(len(fps), -1)
                row, col = np.nonzero(both >= 0)
                out_a.append(both[row, col])
                out_i.append(row)
                out_h.append(np.full(len(row), i == j == 0))
        return np.concatenate(out_a), np.concatenate(out_i), np.concatenate(out_h)


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars spanning the same components as the given links: (member, centre)."""
    nodes, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[:len(u)], flat[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jump = new[new]
            if np.array_equal(jump, new):
                break
            new = jump
        if np.array_equal(new, label):
            break
        label = new
    member = np.nonzero(label != np.arange(len(nodes)))[0]
    return nodes[member], nodes[label[member]]


def _compare(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links found in rows sorted by (anchor, salt) with homes first.

    Holds the homes of one group (bounded by the salting) and one batch of
    visitors; found links are reduced to spanning stars before they are sent.
    """
    found_u: list[np.ndarray] = []
    found_v: list[np.ndarray] = []
    pending = 0
    key, homes = None, np.empty(0, np.int64)

    def flush():
        nonlocal pending
        u, v = _forest(np.concatenate(found_u), np.concatenate(found_v))
        found_u.clear()
        found_v.clear()
        pending = 0
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    for batch in batches:
        if not batch.num_rows:
            continue
        spot = batch.column("spot").to_numpy(zero_copy_only=False)
        fp = batch.column("fp").to_numpy(zero_copy_only=False)
        home = batch.column("home").to_numpy(zero_copy_only=False)
        cuts = np.concatenate([[0], np.nonzero(spot[1:] != spot[:-1])[0] + 1, [len(spot)]])
        counts = np.add.reduceat(home.astype(np.int64), cuts[:-1])
        # Groups without a home have nothing to compare; the first may continue.
        todo = np.nonzero((counts > 0) & (np.diff(cuts) > 0))[0]
        if key is not None and spot[0] == key and (not len(todo) or todo[0] != 0):
            todo = np.concatenate([[0], todo])
        for g in todo:
            lo, hi = cuts[g], cuts[g + 1]
            here = fp[lo:hi]
            own = here[home[lo:hi]]
            if spot[lo] != key:
                key, homes = spot[lo], own
            elif len(own):
                homes = np.concatenate([homes, own])
            if not len(homes) or len(homes) == len(own) == len(here) == 1:
                continue
            # Homes come first, so by now all homes a visitor must meet are here;
            # homes meet each other because each batch is compared with them all.
            step = max(1, (1 << 21) // max(1, len(homes)))
            for at in range(0, len(here), step):
                some = here[at:at + step]
                apart = (some[:, None] ^ homes[None, :]).view(np.uint64)
                near = np.bitwise_count(apart) <= max_bits
                x, y = np.nonzero(near)
                differ = some[x] != homes[y]
                if differ.any():
                    found_u.append(some[x][differ])
                    found_v.append(homes[y][differ])
                    pending += int(differ.sum())
                    if pending > 1 << 20:
                        yield flush()
        last = spot[-1]
        if key != last:
            key, homes = last, np.empty(0, np.int64)
    if pending:
        yield flush()


def links(vertices: DataFrame, max_bits: int = 2, homes_per_group: int = HOMES_PER_GROUP
          ) -> DataFrame:
    """``u``, ``v``: stars that connect exactly the fingerprints which links of
    at most ``max_bits`` bits connect.  ``vertices`` holds distinct ``fp``."""
    code = Covering(max_bits)

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                fps = b.column("fp").slice(at, 4096).to_numpy(zero_copy_only=False)
                anchor, row, home = code.anchors(fps.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(fps[row]), pa.array(home)],
                    ["spot", "fp", "home"])

    spots = schema(("spot", T.LongType()), ("fp", T.LongType()), ("home", T.BooleanType()))
    replicas = vertices.select("fp").mapInArrow(replicate, spots)

    def own_anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zero = Covering(0)
        for b in batches:
            anchor, _, _ = zero.anchors(b.column("fp").to_numpy(zero_copy_only=False)
                                        .view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(anchor)], ["full"])

    # Anchors that are home to many fingerprints: their homes are dealt over
    # salts, and their visitors see every salt.
    full = (vertices.select("fp").mapInArrow(own_anchor, schema(("full", T.LongType())))
            .groupBy("full").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > homes_per_group)
            .select("full", F.ceil(F.col("n") / homes_per_group).cast("long").alias("salts")))
    full = stage(vertices.sparkSession, full, "anchors")
    if not full.isEmpty():
        wide = replicas.join(full, replicas["spot"] == full["full"], "left")
        salts = F.when(F.col("salts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
            F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))
        own = F.pmod(F.xxhash64("fp"), F.coalesce("salts", F.lit(1).cast("long")))
        wide = wide.withColumn("salt", F.explode(salts)).withColumn("own", own)
        replicas = wide.select(
            (F.col("salt") * (1 << 24) + F.col("spot")).alias("spot"), "fp",
            (F.col("home") & (F.col("salt") == F.col("own"))).alias("home"))
    placed = replicas.repartition("spot").sortWithinPartitions("spot", F.desc("home"))
    return placed.mapInArrow(lambda it: _compare(it, max_bits),
                             schema(("u", T.LongType()), ("v", T.LongType())))


# --- connected components ---------------------------------------------------

def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node``, ``root`` (smallest node of its component) of every node that
    has an edge; ``edges`` has columns ``u`` and ``v`` of one type.

    Alternating large-star and small-star rounds: every node points its larger
    (then its smaller) neighbours at the smallest one it knows.  Each half
    round is one map-side combined minimum and one join; each round is written
    to shared storage, which cuts the lineage and survives lost executors.
    """
    spark = edges.sparkSession
    cur = stage(spark, edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                                    F.least("u", "v").alias("v")).distinct(),
                "edges")
    before = None
    for _ in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(small_low, "u")
        new = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small_low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        new = stage(spark, new, "edges")
        after = new.agg(F.count(F.lit(1)).alias("n"),
                        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        cur, same, before = new, after == before, after
        if same:
            roots = cur.select("v").distinct()
            return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
    raise RuntimeError("components did not converge")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 2,
                    homes_per_group: int = HOMES_PER_GROUP) -> DataFrame:
    """``id``, ``fp`` (long), ``th`` (hash of the text), ``root`` (a fingerprint
    that names the class) and ``component_id`` (smallest id reachable over
    links of at most ``max_bits`` bits) of every row of ``docs``."""
    spark = docs.sparkSession
    fps = stage(spark, fingerprints(docs, id_col, text_col, shingle), "simhash")
    vertices = stage(spark, fps.groupBy("fp").agg(F.min("id").alias("least")), "vertices")
    comp = components(links(vertices, max_bits, homes_per_group))
    named = vertices.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.select("fp", "root").join(least, "root")
    return fps.join(classes, "fp").select("id", "fp", "th", "root", "component_id")


def keep_one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of ``docs`` per class, with exactly its columns: the one with the
    smallest id (null last); among rows that repeat that id, the one whose text
    hashes lowest, once."""
    spark = docs.sparkSession
    rows = near_duplicates(docs, id_col, text_col, shingle, max_bits).groupBy(
        "root", "id", "th").agg(F.count(F.lit(1)).alias("n"))
    first = F.min_by(F.struct("id", "th", "n"), F.struct(F.isnull("id"), "id", "th"))
    key, text_hash, times = free_names(docs, "key", "text_hash", "times")
    keep = stage(spark, rows.groupBy("root").agg(first.alias("k")).select(
        F.col("k.id").alias(key), F.col("k.th").alias(text_hash),
        F.col("k.n").alias(times)), "kept")

    def matching(some: DataFrame) -> DataFrame:
        return docs.join(some, docs[f"`{id_col}`"].eqNullSafe(some[key])
                         & (F.xxhash64(docs[f"`{text_col}`"]) == some[text_hash]))

    kept = matching(keep.where(F.col(times) == 1))
    repeated = keep.where(F.col(times) > 1)
    if not repeated.isEmpty():
        kept = kept.unionByName(matching(repeated).dropDuplicates([key, text_hash]))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document (three-word shingles, two bits)."""
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select(F.col("id").alias("doc_id"),
                        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")
