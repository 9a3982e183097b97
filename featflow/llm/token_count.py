"""Token counts by a count-only Viterbi pass over a unigram vocabulary.

The tokenizer is the unigram model of the tokenizers library over a public
vocabulary file of pieces and scores: white space (as the Unicode property has
it) parts words, each word is marked in front with U+2581, and the best-scoring
split into pieces counts.  Only the number of pieces is carried, never a piece:

* an Aho-Corasick automaton over the vocabulary lists all matches that end at
  each position of a word;
* dynamic programming keeps, per position, the best score, the piece count of
  that best split and whether it ends in an unknown character;
* ties go as in the tokenizer: among candidates that end at one position the
  one that begins first wins unless a later one is strictly better, a character
  without a piece of its own costs the lowest score minus ten, unknown
  characters side by side are one unknown piece, and with byte fallback that
  piece counts one token per UTF-8 byte.

Words are counted once per worker (bounded memory) and looked up again, so the
cost follows distinct words.

Defined results: a null or empty text has no tokens; repeated rows are all
returned; an empty table gives an empty table; texts are read whole, however long;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from featflow.llm.common import (WordMemory, id_and_text, pieces, ready, schema, split_words,
                                 table, text_bytes, tokenizer_path, vocabulary)

MARK = "▁"
UNKNOWN_PENALTY = 10.0


@dataclass
class Unigram:
    """Pieces with scores; ``unk_id`` is the piece for unknown characters."""

    pieces: list[tuple[str, float]]
    unk_id: int
    byte_fallback: bool

    @classmethod
    def from_sentencepiece(cls, data: bytes) -> Unigram:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        n = sp.get_piece_size()
        scores = [float(sp.get_score(i)) for i in range(n)]
        least = min(scores)
        # Control and byte pieces must not match text: they get the worst score.
        rows = [(sp.id_to_piece(i), least if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)
                 else scores[i]) for i in range(n)]
        return cls(rows, sp.unk_id(), sum(map(sp.is_byte, range(n))) == 256)

    def library(self):
        """The same tokenizer in the tokenizers library (for checks)."""
        from tokenizers import Tokenizer, models, normalizers, pre_tokenizers
        t = Tokenizer(models.Unigram(self.pieces, self.unk_id, self.byte_fallback))
        t.normalizer = normalizers.Replace(MARK, " ")
        t.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace(prepend_scheme="always")])
        return t


class Counter:
    """Piece counts of words under a unigram model."""

    def __init__(self, model: Unigram):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for piece, score in model.pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in model.pieces) - UNKNOWN_PENALTY
        self.byte_fallback = model.byte_fallback
        #: (tokens, best score) of words met.
        self.memory = WordMemory()

    def word(self, text: str) -> tuple[int, float]:
        """(tokens, best score) of one word, given without its mark."""
        s = MARK + text
        n = len(s)
        ending: list[list] = [[] for _ in range(n)]
        for end, found in self.automaton.iter(s):
            ending[end].append(found)  # the longest, so the earliest start, first
        best, count, open_unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for e in range(1, n + 1):
            top = None
            single = False
            for length, score in ending[e - 1]:
                candidate = score + best[e - length]
                if top is None or candidate > top:
                    top, start = candidate, e - length
                single = single or length == 1
            if not single:
                candidate = self.unknown + best[e - 1]
                if top is None or candidate > top:
                    best[e] = candidate
                    open_unknown[e] = True
                    count[e] = count[e - 1] + (len(s[e - 1].encode()) if self.byte_fallback
                                               else not open_unknown[e - 1])
                    continue
            best[e], count[e] = top, count[start] + 1
        return int(count[n]), best[n]

    def learn(self, words: list[bytes]) -> None:
        self.memory.begin()
        for w in self.memory.unknown(words):
            text = w.decode()
            if w.isascii():
                self.memory[w] = self.word(text)
            else:
                parts = [self.word(x) for x in _SPACES.split(text) if x]
                self.memory[w] = sum(c for c, _ in parts), sum(b for _, b in parts)

    def count(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, best score) of each text of a string column."""
        words, bounds, _, _ = split_words(*text_bytes(col))
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self.learn(distinct)
        found = self.memory.all(distinct)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        per_text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        out = []
        for i in (0, 1):
            values = np.array([f[i] for f in found], np.float64)
            out.append(np.bincount(per_text, values[codes], len(bounds) - 1))
        return out[0].astype(np.int64), out[1].astype(np.float64)


#: White space beyond ASCII, and the mark itself, part words too.
_SPACES = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\u2581]+")

_COUNTERS: dict[int, Counter] = {}


def _counter(shared) -> Counter:
    key = zlib.crc32(shared.value)
    if key not in _COUNTERS:
        _COUNTERS[key] = Counter(Unigram.from_sentencepiece(shared.value))
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, model_file: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``score`` (best log score) of every row."""
    shared = vocabulary(ready(docs.sparkSession), model_file)
    src = id_and_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared)
        for b in pieces(batches):
            tokens, score = counter.count(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(tokens), pa.array(score)],
                ["doc_id", "n_tokens", "score"])

    return src.mapInArrow(run, schema(("doc_id", src.schema["id"].dataType),
                                      ("n_tokens", T.LongType()), ("score", T.DoubleType())))


def op9_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count the tokens of every whole document."""
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
