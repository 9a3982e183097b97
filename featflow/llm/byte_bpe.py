"""Byte-level BPE by recursive DuckDB queries inside each partition.

Encoding: texts are cut into units where the tokenizer's pattern surely begins a
match, each distinct new unit is matched by the pattern, and the distinct new
matches ("words") become token-position rows, one per byte.  A recursive query
joins neighbouring positions with the merge table, contracts every word's
leftmost pair of minimum rank, and goes on until no pair of any word is in the
table; its state is what is not finished yet, each word as its list of tokens.
Words that are tokens themselves need no merging.  Words of 256 bytes or more
are contracted in chunks, which are joined by contracting the tokens around each
border anew.

Decoding: token-position rows join the vocabulary, and an ordered aggregation
puts each document's bytes together.

A task holds one piece of its input (a few MB of text), a memory of words already
encoded that is bounded in bytes, and a DuckDB instance with a memory limit and
no temporary folder; nothing is shared between tasks, so a lost executor only
repeats its tasks.

Defined results: a null text is empty and gives no ids; null and repeated keys
are rows like all others, all returned; an empty table gives an empty table; very
long texts and words are encoded whole; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featflow.llm.common import (USUAL_PATTERN, WordMemory, id_and_text, pieces,
                                 prefix_offsets, ragged_take, ready, schema, split_units, table,
                                 text_bytes, tokenizer_path, vocabulary)

#: Bytes of words contracted by one query.
QUERY_BYTES = 1 << 19
#: From this many bytes on, a word is encoded in chunks that are then joined,
#: and a chunk's equal pairs are contracted together.
LONG_WORD = 256
#: Bytes of the chunks at first.
CHUNK = 128
#: Tokens on either side of a chunk border that are encoded anew.
_SEAM = 8
#: Tokens decoded by one query.
DECODE_TOKENS = 1 << 20

#: The state is a row per word; each round its tokens become token-position
#: rows, joined as pairs with the merge table.  A pair's id and position are
#: packed into one number to find the leftmost pair of minimum rank.  Words
#: without a pair are done and leave the recursion.
_ENCODE = """
WITH RECURSIVE state AS (
  SELECT word, toks, false AS done FROM words
  UNION ALL
  (WITH live AS (SELECT word, toks FROM state WHERE NOT done),
   pairs AS (SELECT word, unnest(toks[:-2]) AS a, unnest(toks[2:]) AS b,
                    unnest(range(1, len(toks))) AS pos FROM live),
   best AS (SELECT word, min((m.id::BIGINT << 32) | pos) AS best
            FROM pairs JOIN merges m ON pairs.a = m.a AND pairs.b = m.b GROUP BY word)
   SELECT word, CASE WHEN best IS NULL THEN toks ELSE
            list_concat(list_concat(toks[:(best & 4294967295) - 1], [(best >> 32)::INTEGER]),
                        toks[(best & 4294967295) + 2:]) END AS toks, best IS NULL AS done
   FROM live LEFT JOIN best USING (word))
)
SELECT word, toks FROM state WHERE done ORDER BY word
"""

#: The same fixpoint for long words: all disjoint occurrences of a word's
#: minimum pair, leftmost first, are contracted in one round.  (A pair made by
#: a merge never ranks below it, so the order among equal pairs is all that
#: counts; in a run of overlapping occurrences every second one is taken.)
#: The state is a row per token, numbered ``word << 32 | byte``.
_ENCODE_LONG = """
WITH RECURSIVE state AS (
  SELECT spot, tok, false AS done FROM (
    SELECT word::BIGINT << 32 | unnest(range(len(toks))) AS spot, unnest(toks) AS tok FROM words)
  UNION ALL
  SELECT spot, CASE WHEN taken THEN best ELSE tok END, best IS NULL
  FROM (
    SELECT *, lag(taken) OVER (ORDER BY spot) AS swallowed,
           lag(spot >> 32) OVER (ORDER BY spot) AS word_before
    FROM (
      SELECT *, hit AND (row_number() OVER (PARTITION BY run, hit ORDER BY spot)) % 2 = 1 AS taken
      FROM (
        SELECT *, n - row_number() OVER (PARTITION BY hit ORDER BY spot) AS run
        FROM (
          SELECT spot, tok, n, best, coalesce(id = best, false) AS hit
          FROM (
            SELECT q.*, m.id, min(m.id) OVER (PARTITION BY q.spot >> 32) AS best
            FROM (SELECT spot, tok, row_number() OVER (ORDER BY spot) AS n,
                         lead(spot) OVER (ORDER BY spot) AS next_spot,
                         lead(tok) OVER (ORDER BY spot) AS next_tok FROM state WHERE NOT done) q
            LEFT JOIN merges m
              ON q.tok = m.a AND q.next_tok = m.b AND q.next_spot >> 32 = q.spot >> 32)))))
  WHERE NOT coalesce(swallowed AND word_before = spot >> 32, false)
)
SELECT (spot >> 32)::INTEGER AS word, list(tok ORDER BY spot) AS toks
FROM state WHERE done GROUP BY spot >> 32 ORDER BY 1
"""

_DECODE = """
SELECT t.doc, string_agg(v.piece, '' ORDER BY t.pos) AS text
FROM tokens t JOIN vocab v ON t.id = v.id GROUP BY t.doc
"""


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and rank of each line of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in data.splitlines() if x)}


def _connect():
    import duckdb
    con = duckdb.connect()
    con.execute("SET threads = 1")
    con.execute("SET memory_limit = '500MB'")
    con.execute("SET temp_directory = ''")  # queries are small; nothing spills to a local folder
    return con


class MergeCodec:
    """Encoder and decoder for one rank file and pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        # White space as the tokenizer's own engine has it (no control characters).
        pattern = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(
            r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.pattern = regex.compile(pattern)
        #: Texts of other patterns are matched as a whole.
        self.usual = pattern == USUAL_PATTERN
        self.con = _connect()
        rows = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items()
                for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        a, b, ids = np.array(rows or [(-1, -1, -1)], np.int32).T
        self._load("merges", {"a": a, "b": b, "id": ids})
        # Bytes as characters from U+0100 on: any byte string is then a text.
        self._load("vocab", {"id": np.fromiter(ranks.values(), np.int32, len(ranks)),
                             "piece": ["".join(chr(256 + x) for x in t) for t in ranks]})
        self.token_bytes = {r: t for t, r in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        #: Ids of units and words met.
        self.memory = WordMemory(40 << 20)

    def _load(self, name: str, columns: dict) -> None:
        self.con.register("_rows", pa.table(columns))
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM _rows")
        self.con.unregister("_rows")

    def _contract(self, words: list[bytes], query: str) -> None:
        """Ids of ``words`` into the memory."""
        bounds = prefix_offsets(list(map(len, words))).astype(np.int32)
        toks = pa.ListArray.from_arrays(
            pa.array(bounds), pa.array(self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]))
        self.con.register("words", pa.table({"word": np.arange(len(words), dtype=np.int32),
                                             "toks": toks}))
        got = self.con.sql(query).to_arrow_table()["toks"].combine_chunks()
        self.con.unregister("words")
        raw = got.flatten().to_numpy().astype("<u4").tobytes()
        a = 0
        for w, b in zip(words, np.cumsum(got.value_lengths().to_numpy() * 4).tolist()):
            self.memory[w] = raw[a:b]
            a = b

    def _batches(self, words: list[bytes], query: str) -> None:
        at = size = 0
        for i, w in enumerate(words):
            size += len(w)
            if size >= QUERY_BYTES or i == len(words) - 1:
                self._contract(words[at:i + 1], query)
                at, size = i + 1, 0

    def learn_words(self, words: list[bytes]) -> None:
        short, long = [], []
        for w in words:
            one = self.ranks.get(w)
            if one is not None:
                self.memory[w] = one.to_bytes(4, "little")
            else:
                (short if len(w) < LONG_WORD else long).append(w)
        self._batches(short, _ENCODE)
        for w in long:
            self.memory[w] = self._giant(w)

    def _giant(self, word: bytes) -> bytes:
        """Ids of a very long word, from those of its chunks.

        An encoding is right exactly if each two neighbouring tokens are what
        the two would be encoded to alone.  So chunks can be joined by encoding
        the tokens around their border anew, provided that the outermost of
        these come out as they were; chunks for which they do not are made one
        (two at a time) and encoded as a whole.
        """
        chunks = [word[i:i + CHUNK] for i in range(0, len(word), CHUNK)]
        known: dict[bytes, np.ndarray] = {}
        while True:
            self._into(known, chunks)
            tokens = [known[c] for c in chunks]
            seams = [(a[-_SEAM:], b[:_SEAM]) for a, b in zip(tokens, tokens[1:])]
            joins = [b"".join([self.token_bytes[t] for t in (*a.tolist(), *b.tolist())])
                     for a, b in seams]
            self._into(known, joins)
            fits = [min(len(tokens[i]), len(tokens[i + 1])) >= 2 * _SEAM
                    and known[j][0] == a[0] and known[j][-1] == b[-1]
                    for i, (j, (a, b)) in enumerate(zip(joins, seams))]
            if all(fits):
                out = []
                for i, t in enumerate(tokens):
                    out.append(t[_SEAM * (i > 0):len(t) - _SEAM * (i < len(joins))])
                    if i < len(joins):
                        out.append(known[joins[i]])
                return np.concatenate(out).astype("<u4").tobytes()
            merged, grown = [chunks[0]], False
            for c, fit in zip(chunks[1:], fits):
                if fit or grown:
                    merged.append(c)
                    grown = False
                else:
                    merged[-1] += c
                    grown = True
            chunks = merged

    def _into(self, known: dict[bytes, np.ndarray], words: list[bytes]) -> None:
        """Ids of words by contraction, whatever their length."""
        new = [w for w in dict.fromkeys(words) if w not in known]
        kept, self.memory = self.memory, WordMemory()  # parts of one word: not worth remembering
        self._batches([w for w in new if len(w) < LONG_WORD], _ENCODE)
        self._batches([w for w in new if len(w) >= LONG_WORD], _ENCODE_LONG)
        for w in new:
            known[w] = np.frombuffer(self.memory[w], "<u4")
        self.memory = kept

    def learn(self, units: list[bytes]) -> None:
        memory, find, cut, words = self.memory, self.pattern.findall, [], []
        for u in memory.unknown(units):
            if u.isascii() and b"'" not in u and self.usual:
                words.append(u)  # one match
                continue
            parts = [x.encode() for x in find(u.decode())]
            if len(parts) > 1:
                cut.append((u, parts))
            words += parts
        self.learn_words(list(dict.fromkeys(memory.unknown(words))))
        for u, parts in cut:
            memory[u] = b"".join([memory[x] for x in parts])

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, text offsets into them) of a string column."""
        if self.usual:
            units, bounds = split_units(*text_bytes(col))
        else:
            words = [[x.encode() for x in self.pattern.findall(t or "")] for t in col.to_pylist()]
            units, bounds = pa.array([x for t in words for x in t], pa.binary()), prefix_offsets(
                list(map(len, words)))
        coded = units.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self.memory.begin()
        self.learn(distinct)
        found = self.memory.all(distinct)
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        values = np.frombuffer(b"".join(found), "<u4")
        codes = coded.indices.to_numpy(zero_copy_only=False)
        per_unit = lengths[codes]
        ids = ragged_take(values, (np.cumsum(lengths) - lengths)[codes], per_unit)
        return ids, prefix_offsets(per_unit)[bounds]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The bytes of each document's ids (``ids[bounds[i]:bounds[i + 1]]``)."""
        out: list[list[bytes]] = [[] for _ in range(len(bounds) - 1)]
        # Documents, cut where a query would hold too many tokens.
        cuts = np.union1d(bounds, np.arange(0, len(ids), DECODE_TOKENS))
        owner = np.searchsorted(bounds, cuts[:-1], side="right") - 1
        part = np.repeat(np.arange(len(cuts) - 1, dtype=np.int32), np.diff(cuts))
        for at in range(0, len(ids), DECODE_TOKENS):
            here = slice(at, at + DECODE_TOKENS)
            self.con.register("tokens", pa.table({
                "doc": part[here], "pos": np.arange(len(part[here]), dtype=np.int32),
                "id": ids[here].astype(np.int32)}))
            for p, text in sorted(self.con.execute(_DECODE).fetchall()):
                out[owner[p]].append(text.encode("utf-16-le")[::2])
            self.con.unregister("tokens")
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]


_CODECS: dict[tuple[int, str], MergeCodec] = {}


def _codec(shared, pattern: str) -> MergeCodec:
    """One codec per worker process, rank file and pattern."""
    key = (zlib.crc32(shared.value), pattern)
    if key not in _CODECS:
        _CODECS[key] = MergeCodec(parse_ranks(shared.value), pattern)
    return _CODECS[key]


def encode(docs: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``id`` and ``ids`` (array of int) of every row."""
    shared = vocabulary(ready(docs.sparkSession), ranks_file)
    src = id_and_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, pattern)
        for b in pieces(batches):
            ids, bounds = codec.encode(b.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)),
                                             pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("id"), lists], ["id", "ids"])

    return src.mapInArrow(run, schema(("id", src.schema["id"].dataType),
                                      ("ids", T.ArrayType(T.IntegerType()))))


def decode(encoded: DataFrame, ranks_file: str, pattern: str, id_col: str = "id",
           ids_col: str = "ids") -> DataFrame:
    """``id`` and ``bytes`` of every row of ids.  Ids that the rank file does not
    have (special or reserved ones) are an error."""
    shared = vocabulary(ready(encoded.sparkSession), ranks_file)
    src = encoded.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, pattern)
        vocab = np.fromiter(codec.token_bytes, np.int64, len(codec.token_bytes))
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                lists = [np.asarray(x if x is not None else [], np.int64)
                         for x in part.column("ids").to_pylist()]
                bounds = prefix_offsets([len(x) for x in lists])
                ids = np.concatenate(lists) if lists else np.empty(0, np.int64)
                unknown = ids[~np.isin(ids, vocab)]
                if len(unknown):
                    raise ValueError(f"{len(unknown)} ids are not in {ranks_file}, "
                                     f"first {np.unique(unknown)[:5].tolist()}")
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(codec.decode(ids, bounds), pa.binary())],
                    ["id", "bytes"])

    return src.mapInArrow(run, schema(("id", src.schema["id"].dataType),
                                      ("bytes", T.BinaryType())))


def round_trip(docs: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``: every
    text encoded, its ids decoded, both digested in the task that has them."""
    shared = vocabulary(ready(docs.sparkSession), ranks_file)
    src = id_and_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, pattern)
        for b in pieces(batches):
            ids, bounds = codec.encode(b.column("text"))
            raw, cuts = ids.astype("<u4").tobytes(), (bounds * 4).tolist()
            digest = [hashlib.sha256(raw[x:y]).hexdigest() for x, y in zip(cuts, cuts[1:])]
            back = [hashlib.sha256(x).hexdigest() for x in codec.decode(ids, bounds)]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(np.diff(bounds)), pa.array(digest, pa.string()),
                 pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return src.mapInArrow(run, schema(
        ("doc_id", src.schema["id"].dataType), ("n_tokens", T.LongType()),
        ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every whole document."""
    import public_tokenizers
    return round_trip(table(spark, sf_dir, "documents"),
                      tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
