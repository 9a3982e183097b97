"""Quality rules judged per host.

Each document is measured once (words, symbols, repeated lines, repeated
five-word windows) and tested by a few rules.  Rule failures are aggregated by
host, each host's failure rate is shrunk towards the corpus by a beta prior
fitted to all hosts (moment matching), and the host verdicts are joined back.

A document that fails a *base* rule goes.  The *soft* rules give each document
one number, its excess: how far its worst measure is beyond its limit (above 1:
the document fails).  How much excess is borne depends on the host, judged
against the corpus by the tails of its posterior (``TAIL`` deviations):

* a trusted host (surely failing less than the corpus) may have documents with
  an excess up to ``LIMITS[0]``: an odd page on an otherwise clean host is kept;
* an ordinary host, up to ``LIMITS[1]`` = 1;
* a distrusted host (surely failing more than the corpus), up to ``LIMITS[2]``:
  documents that come near a limit go too.

Where hosts differ no more than by chance the prior is so strong that all are
ordinary.

Defined results: a null text has no words (so it fails the base rule); a null
host is a host of its own; repeated rows are judged alike and all returned; an
empty table gives an empty table; other columns are ignored, whatever their
names; very long texts are measured whole.

Plan: one Python pass over the documents (Arrow batches, one document at a time,
so memory follows the longest text), staged with their measures; the host
aggregate combines map-side, so a host with a third of all
rows costs one row per task; the join back has one row per host on its right,
and adaptive execution splits a hot host on the left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featflow.llm.common import (byte_texts, free_names, id_and_text, pieces, ready, schema, stage,
                                 table)

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
_SYMBOL_BYTES = [c.encode() for c in SYMBOLS]
_SPACES = b" \t\n\r\x0b\x0c"

#: Words from which on windows are numbered by numpy instead of kept as tuples.
LONG_TEXT = 1 << 16

#: Deviations of the posterior between a host's rate and the corpus rate from
#: which on the host is trusted or distrusted.
TAIL = 2.0
#: Excess borne from trusted, ordinary and distrusted hosts.
LIMITS = (3.0, 1.0, 0.75)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def measure_text(text: bytes | None) -> tuple[int, int, int, int, int, int]:
    """The counts of one text, in the order of ``COUNTS``.

    Words are runs of other bytes than ASCII white space; lengths are in code
    points; a word counts as repeated if it lies in a five-word window that the
    text holds at least twice.
    """
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.split()
    n = len(words)
    spaces = sum(text.count(bytes([b])) for b in _SPACES)
    inner = 0 if text.isascii() else len(text) - len(text.decode())
    symbols = sum(map(text.count, _SYMBOL_BYTES))
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = 0
    if n > LONG_TEXT:
        repeated = _repeated_words(words)
    elif n > 5:
        windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
        if len(set(windows)) < len(windows):
            seen: set[tuple] = set()
            twice: set[tuple] = set()
            for x in windows:
                (twice if x in seen else seen).add(x)
            end = 0
            for i, x in enumerate(windows):
                if x in twice:
                    repeated += i + 5 - max(end, i)
                    end = i + 5
    return (n, len(text) - spaces - inner, symbols, len(lines) - len(set(lines)), repeated,
            len(lines))


def _repeated_words(words: list[bytes]) -> int:
    """The same count for a long text, on word numbers instead of tuples."""
    codes = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    n = len(codes) - 4
    window = codes[:n]
    for i in range(1, 5):  # number the windows of two words, three, ... five
        window = np.unique(window * (codes.max() + 1) + codes[i:n + i], return_inverse=True)[1]
    starts = np.flatnonzero(np.bincount(window)[window] > 1)
    edges = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + 5, -1)
    return int((np.cumsum(edges) > 0).sum())


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        rows = [measure_text(t) for t in byte_texts(b)]
        keep = [i for i, name in enumerate(b.schema.names) if name != "text"]
        yield pa.RecordBatch.from_arrays(
            [b.column(i) for i in keep]
            + [pa.array(c, pa.int64()) for c in zip(*rows)],
            [b.schema.names[i] for i in keep] + list(COUNTS))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            host_col: str = "source") -> DataFrame:
    """``id``, ``host`` and the counts of every document, plus ``base_failed``
    and ``excess``."""
    ready(docs.sparkSession)
    src = id_and_text(docs, id_col, text_col, host_col).withColumnRenamed("x0", "host")
    out = schema(("id", src.schema["id"].dataType), ("host", src.schema["host"].dataType),
                 *[(c, T.LongType()) for c in COUNTS])
    counts = src.mapInArrow(_measure, out)
    return counts.withColumns({"base_failed": base_rule(), "excess": excess()})


def _count(name: str, inside: str | None):
    return F.col(name) if inside is None else F.col(f"`{inside}`")[name]


def base_rule(inside: str | None = None):
    """Too short, or over a fifth of the words repeated; the counts are columns,
    or fields of the column ``inside``."""
    n = _count("n_words", inside)
    return (n < 10) | (100 * _count("n_repeat_words", inside) > 20 * n)


def excess(inside: str | None = None):
    """The worst soft measure over its limit: symbols per word (a tenth), the
    share of repeated lines (half), word length (15 code points; 2 at least).
    Null without words."""
    n, chars, symbols, dup, lines = [_count(c, inside) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines")]
    return F.when(n > 0, F.greatest(10 * symbols / n, 2 * dup / lines, chars / (15 * n),
                                    2 * n / chars))


def host_rates(measured: DataFrame) -> DataFrame:
    """``host``, ``n_docs``, ``n_failed``, ``rate`` (the posterior mean failure
    rate under a beta prior fitted to all hosts) and ``limit`` (the excess that
    documents of the host may have), from rows of ``host``, ``base_failed`` and
    ``excess``.

    The prior's mean is the corpus rate; its strength matches the spread of
    host rates beyond what sampling alone explains.  Only the four sums that
    fix the prior reach the driver.
    """
    hosts = stage(measured.sparkSession, measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(F.col("base_failed") | (F.col("excess") > 1)).alias("n_failed")), "hosts")
    p = F.col("n_failed") / F.col("n_docs")
    mean_all = hosts.agg(F.sum("n_failed").alias("f"), F.sum("n_docs").alias("n"),
                         F.var_pop(p).alias("spread"), F.avg(1 / F.col("n_docs")).alias("inv"))
    row = mean_all.first()
    alpha, beta = beta_prior(row["f"] or 0, row["n"] or 0, row["spread"] or 0.0, row["inv"] or 0.0)
    docs = F.col("n_docs") + F.lit(alpha + beta)
    rate, corpus = F.col("rate"), F.lit(alpha / (alpha + beta) if alpha + beta else 0.0)
    tail = TAIL * F.sqrt(rate * (1 - rate) / (docs + 1))
    return hosts.withColumn("rate", (F.col("n_failed") + F.lit(alpha)) / docs).withColumn(
        "limit", F.when(rate + tail < corpus, LIMITS[0]).when(rate - tail > corpus, LIMITS[2])
        .otherwise(LIMITS[1]))


def beta_prior(failed: int, docs: int, spread: float, inverse: float) -> tuple[float, float]:
    """Moment-matched beta prior; strength between 1 and 1e6 pseudo-documents."""
    m = failed / docs if docs else 0.0
    extra = spread - m * (1 - m) * inverse
    strength = m * (1 - m) / extra - 1 if extra > 0 else 1e6
    strength = min(max(strength, 1.0), 1e6)
    return m * strength, (1 - m) * strength


def judge(measured: DataFrame, rates: DataFrame) -> DataFrame:
    """``measured`` with ``kept``, after joining the host verdicts back."""
    verdict = rates.select(F.col("host").alias("_h"), F.col("limit").alias("_limit"))
    joined = measured.join(verdict, measured["host"].eqNullSafe(verdict["_h"]), "left")
    return joined.withColumn(
        "kept", ~F.col("base_failed") & (F.col("excess") <= F.col("_limit"))
    ).drop("_h", "_limit")


def quality_filter(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with exactly the columns of ``docs``.

    Every text is measured once: the documents are staged with their measures
    (ids may repeat, so they can't carry a verdict back to the right row).
    """
    spark = ready(docs.sparkSession)
    names = free_names(docs, *COUNTS)
    out = T.StructType([*docs.schema.fields, *schema(*[(c, T.LongType()) for c in names]).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, text_col):
            rows = [measure_text(t) for t in byte_texts(b, text_col)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *[pa.array(c, pa.int64()) for c in zip(*rows)]], out.fieldNames())

    counted = stage(spark, docs.mapInArrow(run, out), "measured")
    counts = [F.col(n).alias(c) for n, c in zip(names, COUNTS)]
    rates = host_rates(counted.select(F.col(f"`{host_col}`").alias("host"), *counts)
                       .select("host", base_rule().alias("base_failed"), excess().alias("excess")))
    kept, host, limit = free_names(counted, "kept", "host", "limit")
    # Only passing rows go on; the rules read the counts by their own names.
    marked = counted.withColumn(kept, F.struct(*counts)).select(
        *[F.col(f"`{c}`") for c in docs.columns], kept)
    verdict = rates.select(F.col("host").alias(host), F.col("limit").alias(limit))
    joined = marked.join(verdict, marked[f"`{host_col}`"].eqNullSafe(verdict[host]), "left")
    return joined.where(~base_rule(kept) & (excess(kept) <= F.col(limit))).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and verdict of every document."""
    measured = stage(spark, measure(table(spark, sf_dir, "documents")), "quality")
    return judge(measured, host_rates(measured)).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept",
        F.coalesce(F.col("excess") > 1, F.lit(False)).alias("soft_failed"))


SQL_OP7 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)),
                         lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
m AS (SELECT rid, doc_id, source, ws, len(ws)::BIGINT AS n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             len(ls)::BIGINT AS n_lines,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines FROM w),
g AS (SELECT rid, p, hash(ws[p:p+4]) AS h FROM
        (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS p FROM m WHERE len(ws) >= 5)),
r AS (SELECT rid, p FROM g QUALIFY count(*) OVER (PARTITION BY rid, h) > 1),
rep AS (SELECT rid, count(DISTINCT p + o)::BIGINT AS n FROM r, (SELECT unnest(range(5)) AS o) GROUP BY rid),
c AS (SELECT m.* EXCLUDE (ws), coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM m LEFT JOIN rep USING (rid)),
f AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
             CASE WHEN n_words > 0 THEN greatest(10.0::DOUBLE * n_symbols / n_words, 2.0::DOUBLE * n_dup_lines / n_lines,
               word_chars / (15.0::DOUBLE * n_words), 2.0::DOUBLE * n_words / word_chars) END AS excess FROM c),
h AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed OR excess > 1) AS f
      FROM f GROUP BY source),
a AS (SELECT sum(f)::DOUBLE / sum(n) AS mean, var_pop(f::DOUBLE / n) AS spread, avg(1.0::DOUBLE / n) AS inv FROM h),
s AS (SELECT mean, CASE WHEN spread - mean * (1 - mean) * inv > 0
                   THEN least(greatest(mean * (1 - mean) / (spread - mean * (1 - mean) * inv) - 1, 1.0), 1e6)
                   ELSE 1e6 END AS k FROM a),
p AS (SELECT source, n + (mean * k + (1 - mean) * k) AS docs, (f + mean * k) / (n + (mean * k + (1 - mean) * k)) AS rate,
             mean * k / (mean * k + (1 - mean) * k) AS corpus FROM h, s),
v AS (SELECT source, CASE WHEN rate + 2.0::DOUBLE * sqrt(rate * (1 - rate) / (docs + 1)) < corpus THEN 3.0
                          WHEN rate - 2.0::DOUBLE * sqrt(rate * (1 - rate) / (docs + 1)) > corpus THEN 0.75
                          ELSE 1.0 END AS bearable FROM p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND excess <= bearable AS kept, coalesce(excess > 1, false) AS soft_failed
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""
