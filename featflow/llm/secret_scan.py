r"""Secret scanning with assignment-aware lexing.

Two layers over each whole text:

*Base patterns*, leftmost and non-overlapping per kind, offsets in code points:
``assign`` (a sensitive keyword, ``:`` or ``=``, a value of six characters or
more), ``access`` (``AKIA`` keys of twenty or more) and ``hex`` (runs of 24 or
more lower-case hex digits).

*Lexing*: source and configuration syntax is read into name-literal pairs.
Around each ``=``, ``:`` , ``:=`` or ``=>`` the name on the left (identifier,
dotted path, quoted key or ``["key"]``) and the expression on the right (quoted
strings, bare values, names, joined by ``+`` or adjacency) are parsed.  Literals
bound to names are constants; a name used on a right-hand side stands for its
latest earlier literals, so ``k = "..."; client.password = k`` reports the
literal although ``k`` says nothing (constants propagate through any number of
names, in text order).  Each literal reached is scored by the sensitivity of
the target name and by its own look (length, entropy, mixture of classes,
placeholders); from ``min_score`` on its span is added with kind ``literal``,
unless it lies inside a base span.

Defined results: a null text is empty; a text without secrets has empty spans;
null and repeated keys are rows like all others, all returned; an empty table
gives an empty table; very long texts are scanned whole; other columns are
ignored (``redact`` keeps them, and updates a length column of a whole-number
type).  The work is one pass over the rows with no shuffle; a task holds a few MB
of text.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featflow.llm.common import byte_texts, id_and_text, pieces, ready, schema, table

#: Kinds in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "literal")

_ASSIGN = re.compile(
    rb"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
    rb"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    rb"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")

#: Words that make a target name sensitive, with their weight (fixed values).
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "accesskey": 1.0, "privatekey": 1.0, "credential": 0.9, "credentials": 0.9,
    "auth": 0.6, "bearer": 0.8, "signingkey": 1.0, "encryptionkey": 1.0, "connectionstring": 0.7,
    "key": 0.6, "salt": 0.6,
}

_NAME = rb"[A-Za-z_][A-Za-z0-9_]*(?:[.-][A-Za-z_][A-Za-z0-9_]*)*"
_NAME_BYTES = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-"
_WHOLE_NAME = re.compile(_NAME).fullmatch
#: A name read from its end, so that the longest one is found in one pass.
_NAME_BACK = re.compile(rb"[A-Za-z0-9_]*[A-Za-z_](?:[.-][A-Za-z0-9_]*[A-Za-z_])*")
_SIGN = re.compile(rb"(?::=|=>|==|!=|<=|>=|[:=])[ \t]*")
_RIGHT = re.compile(
    rb"[fFrRbBuU]?\"((?:[^\"\\\n]|\\.)*)\"|[fFrRbBuU]?'((?:[^'\\\n]|\\.)*)'"
    rb"|([A-Za-z0-9+/_.~$@%^-]+(?:(?<=[A-Za-z0-9+/_-]{8})={1,2}(?=[\s\"',;)\]}&]|\Z))?)")
_JOIN = re.compile(rb"[ \t]*(?:\+|\.\.)?[ \t]*")
_WORD_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_PLACEHOLDER = re.compile(
    rb"^(?:x{3,}|\*+|\.+|changeme|example|test(?:ing)?|dummy|none|null|true|false|undefined"
    rb"|your[-_ ].*|<.*>|\$\{.*|%\(.*)$", re.I)


def name_score(name: bytes) -> float:
    """Sensitivity of a target name, from its words and pairs of words."""
    words = [w.lower() for w in _WORD_PARTS.findall(name.decode("ascii", "ignore"))]
    pairs = [a + b for a, b in zip(words, words[1:])]
    return max((SENSITIVE.get(w, 0.0) for w in words + pairs), default=0.0)


def literal_score(value: bytes) -> float:
    """How much a literal looks like a secret, from 0 to 1."""
    n = len(value)
    if n < 6 or _PLACEHOLDER.match(value) or b" " in value.strip() and n < 20:
        return 0.0
    counts = Counter(value)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    classes = sum(bool(re.search(p, value)) for p in (rb"[a-z]", rb"[A-Z]", rb"[0-9]",
                                                     rb"[^A-Za-z0-9]"))
    score = 0.45 * min(1.0, entropy / 4) + 0.3 * min(1.0, n / 20) + 0.25 * min(1.0, classes / 3)
    return score if classes > 1 else 0.6 * score


def base_spans(text: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes of every base match."""
    found = []
    if b":" in text or b"=" in text:
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if b"AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found


def _expression(text: bytes, at: int, end: int) -> list[tuple[str, bytes, int, int]]:
    """Operands from ``at`` to at most ``end``: ("text" or "name" or "bare",
    value, start, end).  A bare value ends at ``&`` and holds no ``=`` but that
    of base64 padding."""
    out = []
    while m := _RIGHT.match(text, at, end):
        if m[3] is not None:
            value = m[3]
            kind = "name" if _WHOLE_NAME(value) else "bare"
            out.append((kind, value, *m.span(3)))
        else:
            group = 1 if m[1] is not None else 2
            out.append(("text", m[group], *m.span(group)))
        glue = _JOIN.match(text, m.end(), end)
        joined = glue[0].strip()
        # Operands go on after a plus, or as quoted strings side by side.
        if not joined and (out[-1][0] != "text" or text[glue.end():min(glue.end() + 1, end)]
                           not in (b'"', b"'")):
            break
        at = glue.end()
    return out


def _name_before(left: bytes) -> bytes | None:
    """The name at the end of ``left`` (the text before an assignment sign),
    perhaps quoted or in brackets, whatever blanks follow it."""
    left = left.rstrip(b" \t")
    for _ in range(2):
        if left[-1:] in (b'"', b"'", b"]"):
            left = left[:-1]
    tail = left[len(left.rstrip(_NAME_BYTES)):]
    m = _NAME_BACK.match(tail[::-1])
    return m[0][::-1] if m else None


def literal_spans(text: bytes, min_score: float = 0.55) -> list[tuple[str, int, int]]:
    """(``literal``, start, end) in bytes of literals that reach sensitive names.

    Every assignment is a node with its own literals and the nodes of the names
    it uses; a sensitive target walks what it can reach.  A node is walked again
    only for a more sensitive target.  Assignments inside a quoted operand (a
    query string, embedded configuration) end with it; where an expression is a
    name and a sign follows (``a = b = "..."``), the first target uses the second
    assignment.  So text is parsed once per level of quotes, and the work follows
    the text's length.
    """
    if b"=" not in text and b":" not in text:
        return []
    nodes: list[tuple[list[tuple[bytes, int, int]], list[int]]] = []
    walked: list[float] = []
    latest: dict[bytes, int] = {}
    found = set()

    def walk(start: int, weight: float) -> None:
        todo = [start]
        while todo:
            i = todo.pop()
            if walked[i] >= weight:
                continue
            walked[i] = weight
            found.update((a, b) for value, a, b in nodes[i][0]
                         if weight * literal_score(value) >= min_score)
            todo += nodes[i][1]

    quotes: list[tuple[int, int]] = []  # quoted operands ahead or around, innermost last
    chained = None  # (end of a lone name on the right, its assignment's node)
    at = 0
    while sign := _SIGN.search(text, at):
        left, begin, at = text[at:sign.start()], sign.start(), sign.end()
        if sign[0][:2] in (b"==", b"!=", b"<=", b">="):
            continue
        name = _name_before(left)  # no name reaches over a sign
        if not name:
            continue
        while quotes and quotes[-1][1] <= begin:
            quotes.pop()
        end = quotes[-1][1] if quotes and quotes[-1][0] <= begin else len(text)
        operands = _expression(text, at, end)
        literals, uses = [], []
        for kind, value, a, b in operands:
            if kind == "name" and value in latest:
                uses.append(latest[value])
            elif kind != "name" or len(value) >= 6:
                literals.append((value, a, b))  # a bare word is a value in configuration
        quotes += [(a, b) for kind, _, a, b in reversed(operands) if kind == "text" and a < b]
        lone = len(operands) == 1 and operands[0][0] == "name"
        if literals or uses or lone:
            here = len(nodes)
            latest[name] = here
            nodes.append((literals, uses))
            walked.append(0.0)
            if weight := name_score(name):
                walk(here, weight)
            if chained and not text[chained[0]:begin].strip(b" \t"):
                nodes[chained[1]][1].append(here)
                if walked[chained[1]]:
                    walk(here, walked[chained[1]])
            chained = (operands[0][3], here) if lone else None
    return [("literal", a, b) for a, b in sorted(found)]


def scan(text: bytes | None, min_score: float = 0.55) -> list[tuple[str, int, int]]:
    """All spans of a text, in code points, by start, then kind, then end."""
    if not text:
        return []
    base = base_spans(text)
    places = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in places]
    reach = list(accumulate((b for _, b in places), max))
    extra = []
    for x in literal_spans(text, min_score):
        before = bisect_right(starts, x[1])
        if not before or reach[before - 1] < x[2]:
            extra.append(x)
    spans = sorted(base + extra, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
    if not text.isascii() and spans:
        spans = _in_code_points(text, spans)
    return spans


def _in_code_points(text: bytes, spans):
    places = sorted({p for _, a, b in spans for p in (a, b)})
    at, count, where = 0, 0, {}
    for p in places:
        count += len(text[at:p].decode("utf-8", "replace"))
        at = p
        where[p] = count
    return [(k, where[a], where[b]) for k, a, b in spans]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_score: float = 0.55) -> DataFrame:
    """``doc_id`` and ``found``, an array of (kind, start, stop, secret)."""
    ready(docs.sparkSession)
    src = id_and_text(docs, id_col, text_col)
    item = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("stop", T.LongType()),
                         T.StructField("secret", T.StringType())])
    out = schema(("doc_id", src.schema["id"].dataType), ("found", T.ArrayType(item)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        kind = to_arrow_type(out["found"].dataType)
        for b in pieces(batches):
            found = []
            for t in byte_texts(b):
                spans = scan(t, min_score)
                s = t.decode() if spans else ""
                found.append([{"kind": k, "start": x, "stop": y, "secret": s[x:y]}
                              for k, x, y in spans])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(found, kind)],
                                             ["doc_id", "found"])

    return src.mapInArrow(run, out)


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
           mask: str = "[SECRET]", min_score: float = 0.55) -> DataFrame:
    """``docs`` with every found span replaced by ``mask`` (overlapping spans by
    one); the length column, where there is one, follows the new text."""
    ready(docs.sparkSession)
    names = docs.columns
    place = names.index(text_col)
    length = names.index(length_col) if length_col in names and isinstance(
        docs.schema[length_col].dataType, T.IntegralType) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, text_col):
            columns = list(b.columns)
            texts = byte_texts(b, text_col)
            changed = {}
            for i, t in enumerate(texts):
                spans = scan(t, min_score)
                if spans:
                    changed[i] = _masked(t.decode(), spans, mask)
            if changed:
                new = [changed.get(i, t) for i, t in enumerate(b.column(text_col).to_pylist())]
                columns[place] = pa.array(new, b.column(text_col).type)
                if length is not None:
                    old = b.column(length_col).to_pylist()
                    columns[length] = pa.array(
                        [len(changed[i]) if i in changed else n for i, n in enumerate(old)],
                        b.column(length_col).type)
            yield pa.RecordBatch.from_arrays(columns, b.schema.names)

    return docs.mapInArrow(run, docs.schema)


def _masked(text: str, spans, mask: str) -> str:
    out, at = [], 0
    for _, a, b in spans:
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]])


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base digest and all spans of every document."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    span = F.transform("found", lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"]))
    base = F.transform(F.filter("found", lambda x: x["kind"] != "literal"),
                       lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"]))

    def count(kind):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(F.concat_ws(",", base), 256).alias("base_sha256"),
        F.concat_ws(",", span).alias("spans"))
