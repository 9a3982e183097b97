"""Exact quantiles of many columns at once, by narrowing histograms.

``percentile`` keeps a counter per distinct value of a group in one reducer,
which ends at some size of the data.  Here a job counts the rows of every
column in equally wide cells (with each cell's least and greatest value), the
driver finds the cell that holds a wanted rank, and the next job looks only at
that cell's range.  Each job is one partial aggregation: a task ships at most
``bins`` rows per open range, whatever the data.  A range is closed when its
rows are all equal or the rank is its first or last row, so no value is ever
collected, and the result is exact.  Rows shrink by up to ``bins`` per job:
three to five jobs for a trillion rows; a heavy tail costs some more, since the
first ranges then hold nearly all rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (column number, least value, greatest value, {rank inside the range: rank})
_Range = tuple[int, float, float, dict[int, int]]


def _cell(v: Column, lo: float, hi: float, bins: int) -> Column:
    """Cell of a value in ``[lo, hi]``; never decreases with the value."""
    if math.isinf(hi - lo):
        share = (v / 2 - lo / 2) / (hi / 2 - lo / 2)
    else:
        share = (v - lo) / (hi - lo)
    return F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")


def _place(ranks: dict[int, int], cells, column: int, found: dict) -> list[_Range]:
    """Settle the ranks that a histogram decides; the ranges left for the rest."""
    todo = sorted(ranks.items())
    out, before, i = [], 0, 0
    for _, n, least, most in sorted(cells):
        rest = {}
        while i < len(todo) and todo[i][0] < before + n:
            offset, rank = todo[i][0] - before, todo[i][1]
            if offset == 0 or least == most:
                found[column, rank] = least
            elif offset == n - 1:
                found[column, rank] = most
            else:
                rest[offset] = rank
            i += 1
        if rest:
            out.append((column, least, most, rest))
        before += n
    return out


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                    bins: int = 1024) -> dict[str, list[float | None]]:
    """Per column the quantiles at ``probabilities``, interpolated linearly
    between neighbouring values as SQL's ``percentile`` (``quantile_cont``) does.

    Nulls and NaNs take no part; infinities count as the least and greatest
    values; a column without values gives nulls.  Reads ``df`` once per round, so
    pass files (:func:`featflow.session.stage`), not a long plan.
    """
    if any(not 0 <= p <= 1 for p in probabilities):
        raise ValueError("probabilities must lie in [0, 1]")
    if bins < 2:
        raise ValueError("at least two bins")
    names = [f"v{i}" for i in range(len(columns))]
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(v) for c, v in zip(columns, names)])
    top = F.lit(math.inf)
    aggs = []
    for v in names:
        x = F.col(v)
        finite = (x > -top) & (x < top)
        aggs.append(F.struct(
            F.count_if(x == -top).alias("low"), F.count_if(finite).alias("n"),
            F.count_if(x == top).alias("high"),
            F.min(F.when(finite, x)).alias("least"), F.max(F.when(finite, x)).alias("most"),
        ).alias(v))
    if not names:
        return {}
    first = values.agg(*aggs).first()
    found: dict[tuple[int, int], float] = {}
    wanted: list[list[float] | None] = []
    ranges: list[_Range] = []
    for c, s in enumerate(first):
        total = s["low"] + s["n"] + s["high"]
        if not total:
            wanted.append(None)
            continue
        wanted.append([p * (total - 1) for p in probabilities])
        inside = {}
        for rank in {r for at in wanted[-1] for r in (math.floor(at), math.ceil(at))}:
            if rank < s["low"]:
                found[c, rank] = -math.inf
            elif rank >= s["low"] + s["n"]:
                found[c, rank] = math.inf
            else:
                inside[rank - s["low"]] = rank
        if inside:
            ranges += _place(inside, [(0, s["n"], s["least"], s["most"])], c, found)
    while ranges:
        entries = []
        for i, (c, lo, hi, _) in enumerate(ranges):
            v = F.col(names[c])
            entries.append(F.when(v.between(lo, hi), F.struct(
                F.lit(i).alias("range"), _cell(v, lo, hi, bins).alias("cell"), v.alias("v"))))
        cells: dict[int, list] = {}
        for r in (values.select(F.inline(F.array_compact(F.array(*entries))))
                  .groupBy("range", "cell")
                  .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"),
                       F.max("v").alias("most")).collect()):
            cells.setdefault(r["range"], []).append((r["cell"], r["n"], r["least"], r["most"]))
        ranges = [left for i, (c, _, _, ranks) in enumerate(ranges)
                  for left in _place(ranks, cells[i], c, found)]

    def value(c: int, at: float) -> float:
        low, high = math.floor(at), math.ceil(at)
        a, b = found[c, low], found[c, high]
        return a if a == b else (high - at) * a + (at - low) * b

    return {name: [None if wanted[c] is None else value(c, at)
                   for at in (wanted[c] or probabilities)]
            for c, name in enumerate(columns)}
