"""Hard-negative mining by bounds from vector segment summaries.

Vectors are scaled to integers; a score is an exact integer inner product.  For
each segment of four components the mean and the deviation (the norm of what is
left after the mean) are stored.  Over a segment of length L

    L * mean_a * mean_b - dev_a * dev_b <= a . b <= L * mean_a * mean_b + dev_a * dev_b

and the sums over all segments bound the score.  Four segments combine to one of
the next coarser level, up to the whole vector.  A search goes from coarse to
fine: pairs whose bounds leave the window of scores that is still wanted are
dropped, the others refined, and only what the finest level leaves is scored.

One search serves both steps.  Every anchor has windows of scores (one without
bounds over rows of its own label for its positives; one per positive over rows
of other labels for its negatives) and wants the k highest scores of each.  Rows
are scanned in partitions; a task holds a bounded buffer of rows and passes all
anchors by it in blocks, read from the staged file in the shared folder (not
through the driver), and gives the best k of each window.  The best of all tasks
are ranked per window, at most k rows from each.  A first scan over a sixteenth
of the rows (by hash of the key) raises the lower ends of the windows to the
scores it finds, so that the scan of the others emits little; nothing is lost,
as k rows at least as good are known.

No key is shuffled but (anchor, window); a label with a third of all rows, or
one vector on a third of them, is spread like any other rows.

Defined results: rows with a null key, label or vector, or a null or non-finite
component take no part; a shorter vector counts as padded with zeros, an empty
one as all zeros; a row is no partner of rows with its own key; rows that
repeat a key are rows of their own (a repeated anchor repeats its results);
equal scores are ordered by key, then arbitrarily among rows of one key; an
empty table gives no rows; other columns are ignored, whatever their names.
Scores of 2^53 or more in magnitude are an error (components of about 46,000 and
more at 64 dimensions and scale 256), as they would not be exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featflow.llm.common import ready, schema, stage, table

#: Components of a segment of the finest level, and segments that combine to one.
SEGMENT = 4
FAN = 4
#: Bytes of vectors a task holds at a time.
BUFFER_BYTES = 32 << 20
#: Anchors of a block, rows of a tile (the first tiles of a buffer are smaller).
ANCHORS, TILE = 512, 2048
#: Anchors in a staged file.
FILE_ANCHORS = 65_536
#: The first scan takes one row in so many.
SEED_SHARE = 16
_LOW, _HIGH = -(1 << 62), 1 << 62


# --- summaries --------------------------------------------------------------

def summarize(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment (vectors padded to whole segments)."""
    parts = vectors.reshape(len(vectors), -1, SEGMENT).astype(float)
    mean = parts.mean(axis=2)
    return mean, np.sqrt(((parts - mean[:, :, None]) ** 2).sum(axis=2))


def levels(mean: np.ndarray, dev: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(mean times root of length, deviation) per level, coarsest first."""
    m, d = mean * np.sqrt(SEGMENT), dev
    out = [(m, d)]
    while m.shape[1] > 1:
        pad = [(0, 0), (0, -m.shape[1] % FAN)]
        m = np.pad(m, pad).reshape(len(m), -1, FAN)
        d = np.pad(d, pad).reshape(len(m), -1, FAN)
        up = m.sum(axis=2) / np.sqrt(FAN)
        d = np.sqrt((d ** 2).sum(axis=2) + ((m - up[:, :, None] / np.sqrt(FAN)) ** 2).sum(axis=2))
        m = up
        out.append((m, d))
    return out[::-1]


class Side:
    """Vectors of one side of a search with the summaries of all levels."""

    def __init__(self, vectors: np.ndarray, mean: np.ndarray, dev: np.ndarray):
        self.vectors = vectors.astype(float)
        self.levels = levels(mean, dev)
        m, d = self.levels[-1]
        self.norm = np.sqrt((m ** 2).sum(axis=1) + (d ** 2).sum(axis=1))


def pairs_within(a: Side, b: Side, ai: np.ndarray, bi: np.ndarray, low: np.ndarray,
                 high: np.ndarray, differs: np.ndarray | None = None, tally=None):
    """(index into ai, index into bi, score) of the pairs whose score may lie
    between ``low`` and ``high`` of the anchor; ``differs`` masks pairs.

    Bounds of a level are taken for all pairs of the tile while many are left,
    else for the pairs left only.  ``tally`` collects pairs left per level.
    """
    lo, hi = low[:, None], high[:, None]
    left = np.ones((len(ai), len(bi)), bool) if differs is None else differs
    slack = 1e-9 * np.outer(a.norm[ai], b.norm[bi]) + 1e-6  # for rounding
    found = None
    for (am, ad), (bm, bd) in zip(a.levels, b.levels):
        if found is None:
            mid = am[ai] @ bm[bi].T
            far = ad[ai] @ bd[bi].T + slack
            left &= (mid + far >= lo) & (mid - far <= hi)
            n = int(np.count_nonzero(left))
            if n * 8 < left.size:
                found = np.nonzero(left)
        else:
            i, j = found
            mid = np.einsum("ij,ij->i", am[ai[i]], bm[bi[j]])
            far = np.einsum("ij,ij->i", ad[ai[i]], bd[bi[j]]) + slack[i, j]
            ok = (mid + far >= low[i]) & (mid - far <= high[i])
            found = i[ok], j[ok]
            n = int(ok.sum())
        if tally is not None:
            tally.append(n)
    if found is None:
        i, j = np.nonzero(left)
        return i, j, (a.vectors[ai] @ b.vectors[bi].T)[left]
    i, j = found
    return i, j, np.einsum("ij,ij->i", a.vectors[ai[i]], b.vectors[bi[j]])


class Best:
    """The k highest (score, then smallest key) of each group."""

    def __init__(self, groups: int, k: int):
        self.score = np.full((groups, k), -np.inf)
        self.key = np.full((groups, k), np.iinfo(np.int64).max)

    @property
    def least(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, group: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        last = self.score[group, -1]
        ok = (score > last) | ((score == last) & (key < self.key[group, -1]))
        if not ok.any():
            return
        group, score, key = group[ok], score[ok], key[ok]
        touched = np.unique(group)
        k = self.score.shape[1]
        g = np.concatenate([np.repeat(touched, k), group])
        s = np.concatenate([self.score[touched].ravel(), score])
        x = np.concatenate([self.key[touched].ravel(), key])
        order = np.lexsort((x, -s, g))
        g, s, x = g[order], s[order], x[order]
        rank = np.arange(len(g)) - np.searchsorted(g, g)
        top = rank < k
        self.score[touched] = s[top].reshape(len(touched), k)
        self.key[touched] = x[top].reshape(len(touched), k)


# --- one search -------------------------------------------------------------

def _matrix(col: pa.Array, kind: str, width: int) -> np.ndarray:
    """Binary values of ``kind`` numbers as rows, padded with zeros to ``width``."""
    item = np.dtype(kind).itemsize
    out = np.zeros((len(col), width), kind)
    sizes = np.array([len(x) for x in col.to_pylist()]) // item
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        some = b"".join(col.take(pa.array(at)).to_pylist())
        out[at, :n] = np.frombuffer(some, kind).reshape(len(at), n)
    return out


def _side(batch: pa.Table, dims: int) -> Side:
    segments = dims // SEGMENT
    return Side(_matrix(batch["q"].combine_chunks(), "<i4", dims),
                _matrix(batch["mean"].combine_chunks(), "<f8", segments),
                _matrix(batch["dev"].combine_chunks(), "<f8", segments))


def _tiles(rows: np.ndarray) -> Iterator[np.ndarray]:
    """The rows in growing tiles, so that early scores raise the thresholds."""
    at, size = 0, 64
    while at < len(rows):
        yield rows[at:at + size]
        at, size = at + size, min(size * 4, TILE)


def search_block(anchors: pa.Table, a: Side, rows: pa.Table, b: Side, labels, k: int,
                 same: bool) -> Best:
    """Best k per (anchor, window) of a block of anchors among buffered rows.

    ``labels`` is (codes of the anchors' labels, of the rows' labels).
    """
    a_label, b_label = labels
    a_key, b_key = anchors["id"].to_numpy(), rows["id"].to_numpy()
    windows = len(anchors["lo"][0])
    lo = np.array(anchors["lo"].to_pylist(), float).reshape(-1, windows)
    hi = np.array(anchors["hi"].to_pylist(), float).reshape(-1, windows)
    best = Best(len(a_key) * windows, k)
    if same:
        groups = [(np.flatnonzero(a_label == v), np.flatnonzero(b_label == v))
                  for v in np.unique(a_label)]
    else:
        groups = [(np.arange(len(a_key)), np.arange(len(b_key)))]
    for ai, bi in groups:
        for tile in _tiles(bi):
            floor = np.maximum(lo, best.least.reshape(lo.shape))[ai]
            ok = a_key[ai][:, None] != b_key[tile][None, :]
            if not same:
                ok &= a_label[ai][:, None] != b_label[tile][None, :]
            i, j, score = pairs_within(a, b, ai, tile, floor.min(axis=1), hi[ai].max(axis=1), ok)
            for w in range(windows):
                fits = (score >= floor[i, w]) & (score <= hi[ai[i], w])
                best.add(ai[i[fits]] * windows + w, score[fits], b_key[tile[j[fits]]])
    return best


_HITS = schema(("aid", T.LongType()), ("win", T.IntegerType()), ("score", T.LongType()),
               ("hit", T.LongType()))


def _scan(rows: DataFrame, anchors: DataFrame, dims: int, k: int, same: bool) -> DataFrame:
    """Best k rows per (anchor, window) of every buffer of rows."""
    files = anchors.inputFiles()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        def block(some: pa.Table):
            codes: dict = {}
            b_label = np.array([codes.setdefault(x, len(codes)) for x in some["label"].to_pylist()])
            b = _side(some, dims)
            for name in files:
                store, path = fs.FileSystem.from_uri(name)
                with store.open_input_file(path) as f:
                    for batch in pq.ParquetFile(f).iter_batches(batch_size=ANCHORS):
                        part = pa.Table.from_batches([batch])
                        if not part.num_rows:
                            continue
                        a_label = np.array([codes.setdefault(x, len(codes))
                                            for x in part["label"].to_pylist()])
                        best = search_block(part, _side(part, dims), some, b, (a_label, b_label),
                                            k, same)
                        windows = len(part["lo"][0])
                        g, _ = np.nonzero(best.score > -np.inf)
                        flat = best.score > -np.inf
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(part["aid"].to_numpy()[g // windows]),
                             pa.array((g % windows).astype(np.int32)),
                             pa.array(best.score[flat].astype(np.int64)), pa.array(best.key[flat])],
                            ["aid", "win", "score", "hit"])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= BUFFER_BYTES:
                yield from block(pa.Table.from_batches(held))
                held, size = [], 0
        if size:
            yield from block(pa.Table.from_batches(held))

    return rows.select("id", "label", "q", "mean", "dev").mapInArrow(run, _HITS)


def _top(hits: DataFrame, k: int) -> DataFrame:
    """The k best of each window with their rank (limited before the shuffle)."""
    order = Window.partitionBy("aid", "win").orderBy(F.desc("score"), "hit")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(rows: DataFrame, anchors: DataFrame, dims: int, k: int, same: bool) -> DataFrame:
    """``aid``, ``win``, ``score``, ``hit`` and ``rank`` (1 to k): for each window
    of each anchor the best rows of its label (``same``) or of other labels.

    ``rows``: staged by :func:`prepare`; ``anchors``: staged rows with ``aid``
    and the windows' ends in the arrays ``lo`` and ``hi``.
    """
    spark = rows.sparkSession
    seed = F.pmod(F.xxhash64("id"), F.lit(SEED_SHARE)) == 0
    first = stage(spark, _top(_scan(rows.where(seed), anchors, dims, k, same), k), "seed-hits")
    found = first.where(F.col("rank") == k).groupBy("aid").agg(
        F.map_from_entries(F.collect_list(F.struct("win", "score"))).alias("found"))
    raised = anchors.join(found, "aid", "left").withColumn(
        "lo", F.when(F.col("found").isNull(), F.col("lo")).otherwise(F.transform(
            "lo", lambda x, i: F.greatest(x, F.col("found")[i.cast("int")])))).drop("found")
    raised = _anchor_files(raised)
    rest = _scan(rows.where(~seed), raised, dims, k, same)
    return stage(spark, _top(first.drop("rank").unionByName(rest), k), "hits")


def _anchor_files(anchors: DataFrame) -> DataFrame:
    """Anchors staged in files of about ``FILE_ANCHORS``."""
    staged = stage(anchors.sparkSession, anchors, "anchors")
    files = -(-staged.count() // FILE_ANCHORS)
    if len(staged.inputFiles()) <= files:
        return staged
    return stage(anchors.sparkSession, staged.coalesce(max(1, files)), "anchor-files")


# --- mining -----------------------------------------------------------------

def prepare(vectors: DataFrame, scale: float = 256.0, id_col: str = "vec_id",
            label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """Staged rows that take part: ``id``, ``label``, ``q`` (scaled components,
    binary of 32-bit integers, whole segments), ``mean`` and ``dev`` (binary of
    doubles, per segment), ``top`` (largest component in magnitude)."""
    spark = ready(vectors.sparkSession)
    src = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                         F.col(f"`{label_col}`").alias("label"),
                         F.col(f"`{vector_col}`").cast("array<double>").alias("vector")).dropna()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column("vector")
            sizes = np.asarray(col.value_lengths().to_numpy(zero_copy_only=False), np.int64)
            values = col.flatten().to_numpy(zero_copy_only=False)  # nulls are NaN
            ends = np.cumsum(sizes)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            fine = bad[ends] == bad[ends - sizes]
            for n in np.unique(sizes[fine]):
                at = np.flatnonzero(fine & (sizes == n))
                v = values[(ends - sizes)[at][:, None] + np.arange(n)[None, :]]
                v = np.floor(scale * v)
                top = np.abs(v).max(axis=1) if n else np.zeros(len(at))
                if len(top) and top.max() >= 1 << 31:
                    raise OverflowError("components too large for exact scores")
                q = np.zeros((len(at), -(-n // SEGMENT) * SEGMENT), "<i4")
                q[:, :n] = v
                mean, dev = summarize(q)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(at)), b.column("label").take(pa.array(at)),
                     *[pa.array([x.tobytes() for x in m], pa.binary())
                       for m in (q, mean.astype("<f8"), dev.astype("<f8"))],
                     pa.array(top.astype(np.int64))],
                    ["id", "label", "q", "mean", "dev", "top"])

    out = schema(("id", T.LongType()), ("label", src.schema["label"].dataType),
                 ("q", T.BinaryType()), ("mean", T.BinaryType()), ("dev", T.BinaryType()),
                 ("top", T.LongType()))
    return stage(spark, src.mapInArrow(run, out), "vectors")


def _share(percent: int, up: bool) -> str:
    """SQL of ``percent`` of ``score``, rounded up or down, in integers."""
    x = f"{percent} * score"
    return f"-((-{x} - pmod(-{x}, 100L)) div 100)" if up else f"({x} - pmod({x}, 100L)) div 100"


def mine(vectors: DataFrame, anchors_every: int = 50, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95, scale: float = 256.0, id_col: str = "vec_id",
         label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """For each anchor (key divisible by ``anchors_every``) and each of its best
    ``positives`` rows of the same label, the best ``negatives`` rows of other
    labels that score ``low`` to ``high`` percent of the positive's score."""
    rows = prepare(vectors, scale, id_col, label_col, vector_col)
    spark = rows.sparkSession
    size = rows.agg(F.max(F.length("q")).alias("bytes"), F.max("top").alias("top")).first()
    dims = max((size["bytes"] or 0) // 4, SEGMENT)
    if dims * (size["top"] or 0) ** 2 >= 1 << 53:
        raise OverflowError("components too large for exact scores")
    anchors = _anchor_files(
        rows.where(F.col("id") % anchors_every == 0).drop("top")
        .withColumn("aid", F.monotonically_increasing_id())
        .withColumn("lo", F.array(F.lit(_LOW))).withColumn("hi", F.array(F.lit(_HIGH))))
    hits = search(rows, anchors, dims, positives, same=True)
    # One row an anchor; windows of equal number, those of missing positives empty.
    windows = hits.select("aid", "rank", F.expr(_share(low, True)).alias("from"),
                          F.expr(_share(high, False)).alias("to")).groupBy("aid").agg(
        F.map_from_entries(F.collect_list(F.struct("rank", F.struct("from", "to")))).alias("w"))
    ends = [F.coalesce(F.col("w")[i + 1][end], F.lit(none))
            for end, none in (("from", _HIGH), ("to", _LOW)) for i in range(positives)]
    wanted = _anchor_files(anchors.drop("lo", "hi").join(windows, "aid").select(
        "aid", "id", "label", "q", "mean", "dev", F.array(*ends[:positives]).alias("lo"),
        F.array(*ends[positives:]).alias("hi")))
    found = search(rows, wanted, dims, negatives, same=False)
    return (found.select("aid", (F.col("win") + 1).alias("nth"), F.col("hit").alias("negative_id"),
                         F.col("score").alias("negative_score"), "rank")
            .join(hits.select("aid", F.col("rank").alias("nth"), F.col("hit").alias("positive_id"),
                              F.col("score").alias("positive_score")), ["aid", "nth"])
            .join(anchors.select("aid", F.col("id").alias("anchor_id")), "aid")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                    "negative_id", "positive_score", "negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of all anchors against all rows (every seventh relabelled)."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", "embedding", label.alias("label")))


SQL_OP12 = """
WITH rows_ AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         list_inner_product(a.q, b.q)::BIGINT AS score
  FROM rows_ a JOIN rows_ b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
pairs AS (
  SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, n.id AS negative_id,
         n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS rank
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM pairs WHERE rank <= 3
"""
