"""Language identification with language-bitmask n-gram filters.

Learning: byte 4-grams of lower-cased letter runs are counted per language over
all labelled texts given (partial counts per task, then one small shuffle).  A
language owns the n-grams that make up at least ``min_rate`` of its own, so it
has at most ``1 / min_rate`` of them whatever the corpus size.

The filter is a bit-sliced Bloom filter: every slot holds one bit per language
(in 64-bit planes), and the bitwise AND of an n-gram's slots gives, in one
look-up, the mask of all languages that contain it.  Per text the bits are
counted per language, each count is corrected for the share of false positives
that its language's slots produce, and the largest corrected share decides.

Defined results: a text that is null or has no letter is ``und`` with score 0;
a text too short for an n-gram, or with none known, gets the most frequent
language with score 0; equal shares go to the language first in order; without
any labelled text everything is ``und``; repeated rows are all returned.

The filter's size is bounded by languages / min_rate, checked before it is
broadcast; tasks hold a few MB of text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featflow.llm.common import id_and_text, pieces, ready, schema, table

UNKNOWN = "und"
GRAM = 4
#: Most distinct languages that a filter is built for.
MAX_LANGUAGES = 1024
#: Most bytes of a filter.
MAX_FILTER_BYTES = 128 << 20
_SLOTS_PER_GRAM = 8
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, owner text of each).  Letter runs are parted by one blank, and
    each text begins and ends with one."""
    raw = [t.lower().encode() if t else b"" for t in texts]
    data = np.frombuffer(b" \0 " + b" \0 ".join(raw) + b" \0 ", np.uint8)
    data = np.where(_LETTER[data] | (data == 0), data, np.uint8(0x20))
    # Texts hold no zero byte of their own any more than they hold letters in
    # it, so zeros are made blanks first and then set at the borders.
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    borders = 1 + np.concatenate([[0], np.cumsum(lengths + 3)])
    data[data == 0] = 0x20
    data[borders] = 0
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 0x20) | (data[:-1] != 0x20)
    owner = np.cumsum(data == 0) - 1
    data, owner = data[keep], owner[keep]
    if len(data) < GRAM:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    codes = data[:-3].astype(np.uint32)
    whole = data[:-3] != 0
    for i in range(1, GRAM):
        part = data[i:len(data) - 3 + i]
        codes = codes << np.uint32(8) | part
        whole &= part != 0
    return codes[whole], owner[:-3][whole]


def count_grams(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang``, ``gram``, ``n`` over all rows with a text and a language."""
    ready(docs.sparkSession)
    src = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")
                      ).where("text IS NOT NULL AND lang IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held_keys, held_counts = [], []

        def merged():
            keys = np.concatenate(held_keys)
            counts = np.concatenate(held_counts)
            found, where = np.unique(keys, return_inverse=True)
            return found, np.bincount(where, counts, len(found)).astype(np.int64)

        def packed():
            keys, counts = merged()
            order = list(names)
            return pa.RecordBatch.from_arrays(
                [pa.array([order[k] for k in (keys >> 32).tolist()], pa.string()),
                 pa.array(keys & 0xFFFFFFFF), pa.array(counts)], ["lang", "gram", "n"])

        size = 0
        for b in pieces(batches):
            codes, owner = grams(b.column("text").to_pylist())
            lang = np.array([names.setdefault(x, len(names))
                             for x in b.column("lang").to_pylist()], np.int64)
            found, counts = np.unique(lang[owner] << 32 | codes, return_counts=True)
            held_keys.append(found)
            held_counts.append(counts)
            size += len(found)
            if size > 1 << 20:  # keep the task's memory bounded
                keys, counts = merged()
                held_keys, held_counts, size = [keys], [counts], len(keys)
                if size > 1 << 19:
                    yield packed()
                    held_keys, held_counts, size = [], [], 0
        if held_keys:
            yield packed()

    counts = src.mapInArrow(run, schema(("lang", T.StringType()), ("gram", T.LongType()),
                                        ("n", T.LongType())))
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class LanguageFilter:
    """Bit-sliced Bloom filter: ``planes[p, slot]`` has bit ``l % 64`` set where
    language ``l`` (``l // 64 == p``) has an n-gram at the slot."""

    languages: list[str]
    fallback: int
    planes: np.ndarray

    @classmethod
    def build(cls, owned: dict[str, np.ndarray], totals: dict[str, int]) -> LanguageFilter:
        languages = sorted(owned)
        n = max(1, sum(len(x) for x in owned.values()))
        bits = max(10, int(np.ceil(np.log2(_SLOTS_PER_GRAM * n))))
        planes = np.zeros((max(1, -(-len(languages) // 64)), 1 << bits), np.uint64)
        out = cls(languages, 0, planes)
        for l, name in enumerate(languages):
            for slot in out._slots(owned[name].astype(np.uint64)):
                np.bitwise_or.at(planes[l // 64], slot, np.uint64(1 << (l % 64)))
        if languages:
            out.fallback = min(range(len(languages)),
                               key=lambda i: (-totals[languages[i]], languages[i]))
        return out

    def _slots(self, codes: np.ndarray) -> list[np.ndarray]:
        shift = np.uint64(64 - int(np.log2(self.planes.shape[1])))
        return [(codes + np.uint64(1)) * np.uint64(s) >> shift for s in _SEEDS]

    def false_rates(self) -> np.ndarray:
        """By language: chance that an n-gram it lacks finds all its bits set."""
        rates = [(self.planes[i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean()
                 for i in range(len(self.languages))]
        return np.array(rates) ** len(_SEEDS)

    def shares(self, codes: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """Corrected share of each text's n-grams that each language contains."""
        slots = self._slots(codes.astype(np.uint64))
        count = np.bincount(owner, minlength=texts)
        out = np.zeros((texts, len(self.languages)))
        false = self.false_rates()
        for p, plane in enumerate(self.planes):
            mask = plane[slots[0]]
            for s in slots[1:]:
                mask &= plane[s]
            for i in range(64 * p, min(64 * p + 64, len(self.languages))):
                hits = np.bincount(owner[(mask >> np.uint64(i % 64) & np.uint64(1)).astype(bool)],
                                   minlength=texts)
                out[:, i] = (hits - count * false[i]) / (1 - false[i])
        return np.clip(out / np.maximum(count, 1)[:, None], 0, 1)


def _most_grams(languages: int, max_bytes: int) -> int:
    """N-grams that a filter of at most ``max_bytes`` can own."""
    planes = -(-languages // 64)
    slots = 1 << max(10, int(np.log2(max(1, max_bytes // (8 * planes)))))
    return slots // _SLOTS_PER_GRAM


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          min_rate: float = 5e-5, max_bytes: int = MAX_FILTER_BYTES) -> LanguageFilter:
    """Fit a filter on all labelled rows of ``docs``.

    Only n-grams above ``min_rate`` of their language reach the driver: at most
    ``1 / min_rate`` per language, and no more in all than ``max_bytes`` of filter
    (but 1,024 slots) can own; where there are more, ``min_rate`` is doubled until
    they fit.
    """
    from featflow.llm.common import stage
    counts = stage(docs.sparkSession, count_grams(docs, text_col, lang_col), "grams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n"))
              .orderBy(F.desc("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(totals) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not totals:
        return LanguageFilter.build({}, {})
    languages = sorted(totals)
    least = F.create_map(*[F.lit(x) for k in languages for x in (k, totals[k] * min_rate)])
    number = F.create_map(*[F.lit(x) for i, k in enumerate(languages) for x in (k, i)])
    # How often min_rate can be doubled without losing the n-gram.
    doublings = F.floor(F.log2(F.col("n") / least[F.col("lang")])).cast("int")
    owned = counts.where(F.col("n") >= least[F.col("lang")]).select(
        number[F.col("lang")].alias("lang"), "gram", doublings.alias("doublings"))
    # At most log2(1 / min_rate) rows.
    sizes = dict(owned.groupBy("doublings").count().collect())
    level, left = 0, sum(sizes.values())
    while left > _most_grams(len(languages), max_bytes):
        level += 1
        left = sum(n for d, n in sizes.items() if d >= level)
    kept = owned.where(F.col("doublings") >= level) if level else owned
    found = kept.select("lang", "gram").toArrow()
    lang, gram = (found.column(c).to_numpy() for c in ("lang", "gram"))
    return LanguageFilter.build({k: gram[lang == i] for i, k in enumerate(languages)}, totals)


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def predict(docs: DataFrame, model: LanguageFilter, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``id``, ``lang_pred`` and ``score`` of every row."""
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # at most max_bytes, see learn()
    src = id_and_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in pieces(batches):
            texts = b.column("text").to_pylist()
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if m.languages:
                share = m.shares(*grams(texts), len(texts))
                best = share.argmax(axis=1)
                for i, t in enumerate(texts):
                    if _has_letter(t):
                        scores[i] = float(share[i, best[i]])
                        names[i] = m.languages[best[i] if scores[i] > 0 else m.fallback]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["id", "lang_pred", "score"])

    return src.mapInArrow(run, schema(("id", src.schema["id"].dataType),
                                      ("lang_pred", T.StringType()), ("score", T.DoubleType())))


def held_out(id_column) -> F.Column:
    """Rows kept out of learning: crc32 of the id's text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op1_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn on the documents not held out, predict all."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    found = predict(docs, model)
    return found.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"),
                        "lang_pred", "score")
