"""Token ids as length-delimited binary records with an offset index.

Documents are ordered by id over the cluster (range partitioning), tokenized
where they land, and each partition writes one record file and one index file:

    record file   header  b"TOKREC01", uint32 bytes per id, uint32 zero
                  record  uint64 length | uint32 masked crc of it |
                          payload | uint32 masked crc of the payload
                  payload uint8 has key, int64 key, then the ids
    index file    per record uint64 offset of the record, uint64 payload length

All numbers are little-endian; crc is CRC-32, masked by rotating 15 bits right
and adding a constant, so that a checksum of checksummed data stays useful.
The index allows reading records in any order.  A manifest (one Parquet row per
committed file) names the files and their first global token; a task that is
run again writes new files, and only files named by the manifest count.

Tokenizing: texts are cut where the tokenizer itself cuts, and only pieces new
to the worker are tokenized (by the tokenizers library; what it remembers is bounded
in bytes), so cost follows distinct words.

Defined results: a null text is empty; equal ids are ordered by a hash of the
text, then by text; null ids come first; an empty table gives a header-only file
or none, and no rows; very long texts are written whole, a record each; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featflow.llm.common import (WordMemory, binary_array, fresh_path, id_and_text, pieces,
                                 prefix_offsets, ragged_take, ready, schema, stage, table,
                                 text_bytes, tokenizer_path, vocabulary)

MAGIC = b"TOKREC01"
_MASK_DELTA = 0xA282EAD8
_HEADER = struct.Struct("<8sII")
_LENGTH = struct.Struct("<QI")
_KEY = struct.Struct("<Bq")
_INDEX = struct.Struct("<QQ")


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK_DELTA) & 0xFFFFFFFF


# --- tokenizing -------------------------------------------------------------

#: Byte classes: 0 white space, 1 letter, 2 digit, 3 other ASCII, 4 anything
#: that keeps its word whole (beyond ASCII, apostrophe, less-than).
_CLASS = np.full(256, 3, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_CLASS[0x30:0x3A] = 2
_CLASS[[*b"'<", *range(0x80, 0x100)]] = 4
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def split_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Cut texts at white space and, in plain ASCII words, where the tokenizer
    itself cuts (letters, single digits, others), lower-casing those words.

    Words with a byte beyond ASCII, an apostrophe (contractions) or a ``<``
    (special tokens) stay whole and as they are.  Returns (pieces, text offsets
    into them).
    """
    kind = _CLASS[data]
    blank = kind == 0
    edge = np.zeros(len(data), bool)  # a word or a gap begins here
    edge[1:] = blank[1:] != blank[:-1]
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    at = np.flatnonzero(edge)
    if len(at):
        odd = np.maximum.reduceat(kind, at) == 4
        odd = np.repeat(odd, np.diff(np.concatenate([at, [len(data)]])))
        kind[odd] = 4
        data = np.where(odd, data, _LOWER[data])
    begins = edge
    begins[1:] |= kind[1:] != kind[:-1]
    begins |= kind == 2
    begins &= ~blank
    starts = np.flatnonzero(begins[~blank])
    packed = data[~blank]
    return (binary_array(packed, np.concatenate([starts, [len(packed)]])),
            np.searchsorted(np.flatnonzero(begins), offsets))


class WordTokenizer:
    """Ids of texts under a lower-casing BPE whose tokens end words with
    ``</w>`` and which drops white space.

    Texts are cut into pieces that the tokenizer never merges across; each
    distinct piece is tokenized once per worker: plain ones many at a time by
    the tokenizer's model, the others by the full tokenizer.
    """

    def __init__(self, data: bytes):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.full = Tokenizer.from_str(data.decode())
        self.bare = Tokenizer(self.full.model)
        self.bare.pre_tokenizer = WhitespaceSplit()
        vocab = self.full.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.width = 2 if self.full.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype("<u2" if self.width == 2 else "<u4")
        self.memory = WordMemory()

    def _plain(self, new: list[bytes]) -> None:
        """Ids of plain pieces, 512 joined; the end marks part them again."""
        chunks = [new[at:at + 512] for at in range(0, len(new), 512)]
        joined = [b" ".join(some).decode() for some in chunks]
        for some, e in zip(chunks, self.bare.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(e.ids, self.kind)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(some):
                self._whole(some)
                continue
            raw, a = ids.tobytes(), 0
            for x, b in zip(some, (stops * self.width).tolist()):
                self.memory[x] = raw[a:b]
                a = b

    def _whole(self, new: list[bytes]) -> None:
        found = self.full.encode_batch_fast([x.decode() for x in new], add_special_tokens=False)
        for x, e in zip(new, found):
            self.memory[x] = np.array(e.ids, self.kind).tobytes()

    def learn(self, distinct: list[bytes]) -> None:
        self.memory.begin()
        new = self.memory.unknown(distinct)
        plain = [x for x in new if x.isascii() and x.decode().isprintable()
                 and b"'" not in x and b"<" not in x]
        if len(plain) < len(new):
            odd = set(plain)
            self._whole([x for x in new if x not in odd])
        self._plain(plain)

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, text offsets into them) of a string column."""
        parts, bounds = split_pieces(*text_bytes(col))
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self.learn(distinct)
        found = self.memory.all(distinct)
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // self.width
        values = np.frombuffer(b"".join(found), self.kind)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        per_piece = lengths[codes]
        ids = ragged_take(values, (np.cumsum(lengths) - lengths)[codes], per_piece)
        return ids, prefix_offsets(per_piece)[bounds]


_TOKENIZERS: dict[int, WordTokenizer] = {}


def _tokenizer(shared) -> WordTokenizer:
    """One tokenizer (and its word cache) per worker process and vocabulary."""
    key = zlib.crc32(shared.value)
    if key not in _TOKENIZERS:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _TOKENIZERS[key] = WordTokenizer(shared.value)
    return _TOKENIZERS[key]


# --- files ------------------------------------------------------------------

def _filesystem(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


class RecordWriter:
    def __init__(self, path: str, width: int):
        files, at = _filesystem(path)
        files.create_dir(at.rpartition("/")[0], recursive=True)
        self.out = files.open_output_stream(at)
        self.index = files.open_output_stream(at + ".idx")
        self.out.write(_HEADER.pack(MAGIC, width, 0))
        self.offset = _HEADER.size

    def write(self, key: int | None, ids: bytes) -> None:
        payload = _KEY.pack(key is not None, key or 0) + ids
        n = struct.pack("<Q", len(payload))
        frame = b"".join([n, struct.pack("<I", masked_crc(n)), payload,
                          struct.pack("<I", masked_crc(payload))])
        self.index.write(_INDEX.pack(self.offset, len(payload)))
        self.out.write(frame)
        self.offset += len(frame)

    def close(self) -> None:
        self.out.close()
        self.index.close()


def _payload(key_and_ids: bytes, kind: np.dtype) -> tuple[int | None, np.ndarray]:
    has, key = _KEY.unpack_from(key_and_ids)
    return key if has else None, np.frombuffer(key_and_ids, kind, offset=_KEY.size)


def _checked(data: bytes, crc: int, what: str) -> bytes:
    if masked_crc(data) != crc:
        raise ValueError(f"damaged {what}")
    return data


def read_file(path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """Records of one file in order, checksums verified."""
    files, at = _filesystem(path)
    with files.open_input_stream(at, buffer_size=1 << 20) as f:
        magic, width, _ = _HEADER.unpack(f.read(_HEADER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token record file")
        kind = np.dtype("<u2" if width == 2 else "<u4")
        while head := f.read(_LENGTH.size):
            n, crc = _LENGTH.unpack(head)
            _checked(head[:8], crc, "length")
            payload = f.read(n)
            _checked(payload, struct.unpack("<I", f.read(4))[0], "record")
            yield _payload(payload, kind)


def read_record(path: str, number: int) -> tuple[int | None, np.ndarray]:
    """Record ``number`` of a file, found through its index (shuffled reads)."""
    files, at = _filesystem(path)
    with files.open_input_file(at + ".idx") as f:
        f.seek(number * _INDEX.size)
        offset, n = _INDEX.unpack(f.read(_INDEX.size))
    with files.open_input_file(at) as f:
        _, width, _ = _HEADER.unpack(f.read(_HEADER.size))
        f.seek(offset + _LENGTH.size)
        payload = f.read(n)
        _checked(payload, struct.unpack("<I", f.read(4))[0], "record")
    return _payload(payload, np.dtype("<u2" if width == 2 else "<u4"))


_MANIFEST = schema(("part", T.IntegerType()), ("path", T.StringType()), ("n_docs", T.LongType()),
                   ("n_tokens", T.LongType()))


def write_token_files(docs: DataFrame, tokenizer_file: str, end_id: int, out_dir: str | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents in ascending id order; return the manifest with
    ``first_token`` (ids in all files before)."""
    spark = ready(docs.sparkSession)
    shared = vocabulary(spark, tokenizer_file)
    root = out_dir or fresh_path(spark, "tokens")
    src = id_and_text(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(shared)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], tok.kind).tobytes()
        out, path, n_docs, n_tokens = None, "", 0, 0
        for b in pieces(batches, limit=8 << 20):
            if out is None:
                path = f"{root}/part-{part:06d}-{uuid.uuid4().hex[:12]}.rec"
                out = RecordWriter(path, tok.width)
            ids, bounds = tok.encode(b.column("text"))
            raw, cuts = ids.tobytes(), (bounds * tok.width).tolist()
            for i, key in enumerate(b.column("id").to_pylist()):
                out.write(key, raw[cuts[i]:cuts[i + 1]] + end)
            n_docs += b.num_rows
            n_tokens += len(ids) + b.num_rows
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "path": [path], "n_docs": [n_docs],
                 "n_tokens": [n_tokens]})

    # The hash deals the rows of one id (or none) over many ranges.
    placed = (src.withColumn("mix", F.xxhash64("text")).repartitionByRange("id", "mix")
              .sortWithinPartitions("id", "mix", "text").drop("mix"))
    manifest = stage(spark, placed.mapInArrow(write, _MANIFEST), "token-manifest")
    # One row per file, so one window partition is small.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first_token",
                               F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


def read_token_files(manifest: DataFrame, per_record) -> DataFrame:
    """Rows made from the files' records.

    ``per_record`` is (schema, function); the function gets (key, ids, first
    token of the record) and returns one row as a tuple.
    """
    out, fn = per_record
    names = out.fieldNames()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        kinds = [to_arrow_type(f.dataType) for f in out.fields]

        def packed(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for b in batches:
            for path, first in zip(b.column("path").to_pylist(),
                                   b.column("first_token").to_pylist()):
                rows = []
                for key, ids in read_file(path):
                    rows.append(fn(key, ids, first))
                    first += len(ids)
                    if len(rows) >= 4096:
                        yield packed(rows)
                        rows = []
                if rows:
                    yield packed(rows)

    files = manifest.count()
    return (manifest.select("path", "first_token").repartition(max(1, files))
            .mapInArrow(read, out))


def _digest(key, ids, first):
    return key, first, len(ids), zlib.crc32(ids.astype("<u4").tobytes())


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every document's ids, read the files back, digest each record."""
    manifest = write_token_files(table(spark, sf_dir, "documents"),
                                 tokenizer_path("word_bpe_49k.json"), end_id=2)
    out = schema(("doc_id", T.LongType()), ("start", T.LongType()), ("n_tokens", T.LongType()),
                 ("ids_crc32", T.LongType()))
    return read_token_files(manifest, (out, _digest))
