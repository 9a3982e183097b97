"""Small helpers shared by the text operators: inputs, batches, types."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featflow.session import fresh_path, ship_package, stage

__all__ = ["arrow_type", "byte_texts", "fresh_path", "id_and_text", "pieces", "ready",
           "stage", "table"]

#: Bytes of text handled at a time inside a task (a longer text is one piece).
PIECE_BYTES = 4 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Make the package importable in the Python workers of this application."""
    ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Only the columns an operator reads, under fixed names (``id``, ``text``,
    then ``more`` as ``x0``, ``x1``, ...), so other columns can't clash."""
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                       *[F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(more)])


def free_names(docs: DataFrame, *wanted: str) -> list[str]:
    """Column names like ``wanted`` that ``docs`` does not have (in any case)."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def arrow_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(t)


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds about ``limit`` bytes of text."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(size, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, done + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def byte_texts(batch: pa.RecordBatch, text: str = "text") -> list[bytes | None]:
    """The texts as UTF-8 bytes (None where null)."""
    col = batch.column(text)
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return col.cast(kind).to_pylist()


_SPACE = None


def _space_table():
    global _SPACE
    import numpy as np
    if _SPACE is None:
        _SPACE = np.zeros(256, bool)
        _SPACE[[0x20, *range(0x09, 0x0E)]] = True
    return _SPACE


def text_bytes(col: pa.Array):
    """(bytes, offsets): the UTF-8 of a string column end to end (null: empty),
    as numpy arrays; text i is ``bytes[offsets[i]:offsets[i + 1]]``."""
    import numpy as np
    import pyarrow.compute as pc

    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offs, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def binary_array(data, offsets) -> pa.Array:
    """Arrow binary values ``data[offsets[i]:offsets[i + 1]]``, without a copy."""
    import numpy as np
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int32)),
         pa.py_buffer(np.ascontiguousarray(data))])


def split_words(data, offsets):
    """Words (runs of bytes other than ASCII white space) of each text.

    Returns (words as Arrow binary, text offsets into them, start and end byte
    of each word).
    """
    import numpy as np

    blank = _space_table()[data]
    begins = ~blank
    begins[1:] &= blank[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[heads] = ~blank[heads]
    starts = np.flatnonzero(begins)
    stops = np.zeros(len(data) + 1, bool)  # a word ends before a blank or a new text
    stops[1:] = ~blank
    stops[1:-1] &= blank[1:]
    tails = offsets[1:][offsets[:-1] < offsets[1:]]
    stops[tails] = ~blank[tails - 1]
    ends = np.flatnonzero(stops)
    bounds = np.concatenate([[0], np.cumsum(ends - starts)])
    return (binary_array(data[~blank], bounds), np.searchsorted(starts, offsets), starts, ends)


#: Byte classes: 0 ASCII white space, 1 letter, 2 digit, 3 other ASCII, 4 beyond.
_KIND = None


def _kinds():
    global _KIND
    import numpy as np
    if _KIND is None:
        _KIND = np.full(256, 3, np.uint8)
        _KIND[[0x20, *range(0x09, 0x0E)]] = 0
        _KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
        _KIND[0x30:0x3A] = 2
        _KIND[0x80:] = 4
    return _KIND


#: The pattern of byte-level tokenizers (a fixed value of their format).
USUAL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
                 r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def split_units(data, offsets, whole: tuple[bytes, ...] = ()):
    """Each text cut where ``USUAL_PATTERN`` (contractions, runs
    of letters, digits or others with at most one space before, white space)
    surely begins a match.  Returns (units, text offsets into them); the units
    of a text join to the text.

    Cuts are made before runs of ASCII white space, before the last one of a run
    and, if it is no space, behind it where ASCII follows, and between ASCII
    letters, digits and others, except behind an apostrophe.  So a unit that is
    ASCII and has no apostrophe is one match.  Where other than ASCII is
    involved nothing is cut, nor inside the strings ``whole`` or the white space
    before them.
    """
    import numpy as np

    n = len(data)
    cut = np.zeros(n + 2, bool)
    if n > 1:
        kind = _kinds()[data]
        a, b, ka, kb = data[:-1], data[1:], kind[:-1], kind[1:]
        starts = offsets[:-1][offsets[:-1] < n]
        word = (kind >= 1) & (kind <= 3)
        here = (ka != 0) & (kb == 0)
        if (kind == 4).any():  # white space beyond ASCII, then ASCII's: one run
            at = np.flatnonzero(here & (ka == 4)) + 1
            back = [data[np.maximum(at - k, 0)].astype(np.int32) for k in (1, 2, 3)]
            two = back[1] << 8 | back[0]
            here[at[(two == 0xC285) | (two == 0xC2A0)
                    | np.isin(back[2] << 16 | two, _WIDE_SPACE)] - 1] = False
        follows = np.zeros(n, bool)  # ASCII other than white space of the same text is next
        follows[:-1] = word[1:]
        follows[starts[starts > 0] - 1] = False
        here |= (ka == 0) & (kb == 0) & follows[1:]
        here |= (ka == 0) & (a != 0x20) & word[1:]
        here |= word[:-1] & word[1:] & (ka != kb) & (a != 0x27)
        cut[1:n] = here
        raw = data.tobytes() if whole else b""
        for s in whole:
            at = raw.find(s)
            while at >= 0:
                cut[at + 1:at + len(s)] = False
                cut[max(at - 1, 0)] &= not (at > 1 and kind[at - 1] == 0 and kind[at - 2] == 0)
                at = raw.find(s, at + 1)
        cut[starts] = True
    elif n:
        cut[0] = True
    begins = np.flatnonzero(cut[:n])
    return binary_array(data, np.concatenate([begins, [n]])), np.searchsorted(begins, offsets)


#: White space of three UTF-8 bytes (fixed values of the Unicode property).
_WIDE_SPACE = [int.from_bytes(chr(c).encode(), "big") for c in
               (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def ragged_take(values, starts, lengths):
    """Concatenated ``values[starts[i]:starts[i] + lengths[i]]``."""
    import numpy as np

    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
    return values[at]


def prefix_offsets(lengths):
    import numpy as np
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


class WordMemory:
    """What a worker remembers of words (by their bytes), bounded in bytes.

    Two generations; once the newer one holds ``limit`` bytes it becomes the
    older one, and what is met again moves on.  Words of ``longest`` bytes or
    more are kept for the current call only.
    """

    #: Cost of an entry beside its key and value.
    ENTRY = 170

    def __init__(self, limit: int = 64 << 20, longest: int = 512):
        self.limit, self.longest = limit, longest
        self.new: dict = {}
        self.old: dict = {}
        self.passing: dict = {}
        self.size = 0

    def begin(self) -> None:
        """Start a call: forget long words, change generations if it is time."""
        self.passing = {}
        if self.size > self.limit:
            self.new, self.old, self.size = {}, self.new, 0

    def unknown(self, words: Iterable[bytes]) -> list[bytes]:
        """Those of ``words`` that are not remembered."""
        new, old, passing, out = self.new, self.old, self.passing, []
        for w in words:
            if w not in new and w not in passing:
                if w in old:
                    self[w] = old[w]
                else:
                    out.append(w)
        return out

    def __contains__(self, word: bytes) -> bool:
        return word in self.new or word in self.passing

    def __getitem__(self, word: bytes):
        return self.new[word] if word in self.new else self.passing[word]

    def __setitem__(self, word: bytes, value) -> None:
        if len(word) >= self.longest:
            self.passing[word] = value
        else:
            self.new[word] = value
            self.size += len(word) + len(value) + self.ENTRY

    def all(self, words: list[bytes]) -> list:
        """The values of words that are all known."""
        if self.passing:
            return [self[w] for w in words]
        return list(map(self.new.__getitem__, words))


#: Largest vocabulary file sent to every executor.
VOCABULARY_BYTES = 64 << 20


def vocabulary(spark: SparkSession, path: str):
    """A tokenizer's file as a broadcast; its size is checked first."""
    import os
    if os.path.getsize(path) > VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {VOCABULARY_BYTES} bytes")
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
