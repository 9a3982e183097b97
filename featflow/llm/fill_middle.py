"""Fill-in-the-middle transformation by block rotations in a byte buffer.

A text is cut into units (lines), two cuts split it into prefix, middle and
suffix.  The buffer first holds the blocks in reading order, each behind its
sentinel,

    <P> prefix <M> middle <S> suffix

and one rotation exchanges two neighbouring blocks: the last two for the form
``psm``, the first two (as one block) with the third for ``spm``.  A rotation is
three reversals (left block, right block, both), done in place with a small
fixed buffer, so a text costs its own size however long it is.  Rotations are
undone by reversing in the opposite order: :func:`restore` finds the sentinels
of an output, rotates back and removes them, which gives the exact text.

A text that holds a sentinel stays ``plain``; sentinels that could overlap each
other are refused, so the first occurrence of each in an output is the one that
was inserted.

Everything is row-local: no shuffle, no state between rows.

Defined results: a null or empty text has no unit, form ``plain`` and an empty
output; a null key draws as the empty string would; equal rows give equal
results, all of them returned; an empty table gives an empty table; other
columns are ignored, whatever their names; long texts are transformed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featflow.llm.common import id_and_text, pieces, ready, schema, table, text_bytes

#: Bytes exchanged at a time by a reversal.
_SWAP = 1 << 16
_NEWLINE = 0x0A


@dataclass(frozen=True)
class Sentinels:
    prefix: bytes = b"<P>"
    suffix: bytes = b"<S>"
    middle: bytes = b"<M>"

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        for a in marks:
            for b in marks:
                if not a or (a is not b and a in b) or any(
                        a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
                    raise ValueError(f"sentinels {a!r} and {b!r} can overlap")
        if len(set(marks)) < 3:
            raise ValueError("sentinels must differ")

    def __iter__(self):
        return iter((self.prefix, self.suffix, self.middle))


@dataclass(frozen=True)
class Draw:
    """How a key decides cuts and form: the first four 32-bit groups of the
    SHA-256 of ``salt`` and the decimal key; ``rate`` and ``spm`` in percent."""
    salt: str = "7:"
    rate: int = 100
    spm: int = 50

    def numbers(self, key) -> tuple[int, ...]:
        digest = hashlib.sha256(f"{self.salt}{'' if key is None else key}".encode()).digest()
        return tuple(int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4))


# --- rotations --------------------------------------------------------------

def reverse(buf: np.ndarray) -> None:
    """Reverse a byte view in place, ``_SWAP`` bytes at a time."""
    half = len(buf) // 2
    for a in range(0, half, _SWAP):
        b = min(a + _SWAP, half)
        left, right = buf[a:b], buf[len(buf) - b:len(buf) - a]
        kept = left[::-1].copy()
        left[:] = right[::-1]
        right[:] = kept


def rotate(buf: np.ndarray, cut: int) -> None:
    """``buf[:cut] + buf[cut:]`` becomes ``buf[cut:] + buf[:cut]``."""
    reverse(buf[:cut])
    reverse(buf[cut:])
    reverse(buf)


def unrotate(buf: np.ndarray, cut: int) -> None:
    """Undo ``rotate(buf, cut)``: its reversals, last one first."""
    reverse(buf)
    reverse(buf[cut:])
    reverse(buf[:cut])


def transform(text: bytes, form: str, a: int, b: int, marks: Sentinels) -> bytearray:
    """Output of ``form`` for a text cut at the bytes ``a`` and ``b``."""
    buf = bytearray(text)
    buf[b:b] = marks.suffix
    buf[a:a] = marks.middle
    buf[0:0] = marks.prefix
    middle = len(marks.prefix) + a  # where the middle and the suffix block begin
    suffix = middle + len(marks.middle) + b - a
    view = np.frombuffer(buf, np.uint8)
    if form == "psm":
        rotate(view[middle:], suffix - middle)
    else:
        rotate(view, suffix)
    return buf


def invert(output: bytes, form: str, marks: Sentinels) -> bytes:
    """The text that :func:`transform` was given, from output and form alone."""
    if form == "plain":
        return output
    buf = bytearray(output)
    view = np.frombuffer(buf, np.uint8)
    at = {m: output.index(m) for m in marks}  # the same offsets before any move
    if form == "psm":
        first = at[marks.suffix]
        cut = len(buf) - at[marks.middle]  # length of the middle block
        unrotate(view[first:], cut)
        middle, suffix = first, first + cut
    else:
        suffix = len(buf) - at[marks.prefix]  # length of prefix and middle block
        unrotate(view, suffix)
        middle = at[marks.middle] - at[marks.prefix]
    del view
    del buf[suffix:suffix + len(marks.suffix)]
    del buf[middle:middle + len(marks.middle)]
    del buf[:len(marks.prefix)]
    return bytes(buf)


# --- Spark ------------------------------------------------------------------

def _chars(data: np.ndarray) -> int:
    """Code points in UTF-8 bytes."""
    return len(data) - int(np.count_nonzero((data & 0xC0) == 0x80))


def fill_in_middle(docs: DataFrame, draw: Draw = Draw(), marks: Sentinels = Sentinels(),
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n`` (lines), ``form``, ``prefix_chars``, ``middle_chars`` (null
    where plain) and ``output`` of every row."""
    ready(docs.sparkSession)
    src = id_and_text(docs, id_col, text_col)

    def one(key, raw: np.ndarray):
        text = raw.tobytes()
        ends = np.flatnonzero(raw == _NEWLINE) + 1
        if len(raw) and (not len(ends) or ends[-1] < len(raw)):
            ends = np.append(ends, len(raw))
        n = len(ends)
        h1, h2, h3, h4 = draw.numbers(key)
        if not text or any(m in text for m in marks) or h3 % 100 >= draw.rate:
            return n, "plain", None, None, text
        cuts = np.concatenate([[0], ends])
        i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = int(cuts[i]), int(cuts[j])
        form = "spm" if h4 % 100 < draw.spm else "psm"
        return (n, form, _chars(raw[:a]), _chars(raw[a:b]),
                bytes(transform(text, form, a, b, marks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            data, offsets = text_bytes(b.column("text"))
            keys = b.column("id").to_pylist()
            n, form, prefix, middle, out = zip(*[one(k, data[x:y]) for k, x, y in
                                                 zip(keys, offsets, offsets[1:])])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                 pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                 pa.array(out, pa.binary()).cast(pa.string())],
                ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return src.mapInArrow(run, schema(
        ("id", src.schema["id"].dataType), ("n", T.LongType()), ("form", T.StringType()),
        ("prefix_chars", T.LongType()), ("middle_chars", T.LongType()),
        ("output", T.StringType())))


def restore(made: DataFrame, marks: Sentinels = Sentinels(), output_col: str = "output",
            form_col: str = "form", into: str = "restored") -> DataFrame:
    """All columns of ``made`` and ``into``: the text rebuilt from output and
    form (null where either is null)."""
    ready(made.sparkSession)
    out = T.StructType([*made.schema.fields, T.StructField(into, T.StringType())])
    names = out.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, output_col):
            forms = b.column(form_col).to_pylist()
            outputs = b.column(output_col).cast(pa.binary()).to_pylist()
            texts = [None if o is None or f is None else invert(o, f, marks)
                     for o, f in zip(outputs, forms)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(texts, pa.binary()).cast(pa.string())], names)

    return made.mapInArrow(run, out)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transform every whole document, rebuild it from the output, digest both."""
    made = restore(fill_in_middle(table(spark, sf_dir, "documents")))
    return made.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


SQL_OP11 = """
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
lines AS (
  SELECT *, regexp_extract_all(text, '[^\\n]*\\n|[^\\n]+') AS units,
         ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM base),
cuts AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                   OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM lines),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS p,
         array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:n], '') AS s
  FROM cuts)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
