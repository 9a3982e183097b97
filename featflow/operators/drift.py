"""Fixed-edge histograms per group and drift metrics against a baseline group.

Histogram semantics are numpy's ``histogram(x, bins=edges)``: bins are
``[e_i, e_{i+1})`` except the last, ``[e_{n-1}, e_n]``; values outside the
edges, NaN and null are not counted.  Counting is one aggregation with
partial (map-side) combine, so a group holding a third of all rows costs one
partial row per map task, not a hot reducer.

Metrics compare two count arrays over the same bins, ``x`` = baseline,
``y`` = group, and are array higher-order functions evaluated in the JVM on
group-level rows:

* ``psi``  -- counts clipped below at 1e-4, divided by the *unclipped* sums,
  ``sum((x - y) * ln(x / y))``;
* ``kl_div`` -- same clipping, ``sum(x * ln(x / y))`` (baseline || group);
* ``js`` -- Jensen-Shannon *distance* on the normalised raw counts,
  ``sqrt((KL(p||m) + KL(q||m)) / 2)``, natural log;
* ``wasserstein_distance`` -- the two mass lists taken as samples (bin
  positions are not used): mean of ``|sorted p - sorted q|``.

An empty group (sum 0) yields null metrics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featflow.session import stage

CLIP = 1e-4


def _check_edges(edges: Sequence[float]) -> list[float]:
    e = [float(v) for v in edges]
    if len(e) < 2:
        raise ValueError("need at least two edges")
    if any(b < a for a, b in zip(e, e[1:])):
        raise ValueError("edges must be monotonically increasing")
    return e


def _search(x: Column, e: list[float], lo: int, hi: int) -> Column:
    if hi - lo == 1:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(x < F.lit(e[mid]), _search(x, e, lo, mid)).otherwise(_search(x, e, mid, hi))


def bin_index(x: Column, edges: Sequence[float]) -> Column:
    """0-based bin of ``x`` (INT) or null; a balanced comparison tree, log2 deep."""
    e = _check_edges(edges)
    x = x.cast("double")
    outside = x.isNull() | F.isnan(x) | (x < F.lit(e[0])) | (x > F.lit(e[-1]))
    return F.when(outside, F.lit(None).cast("int")).otherwise(_search(x, e, 0, len(e) - 1))


def histogram(df: DataFrame, value_col: str, edges: Sequence[float],
              group_cols: Sequence[str] | str) -> DataFrame:
    """Per group: ``dist`` (ARRAY<BIGINT> counts) and ``bins`` (ARRAY<DOUBLE> edges).

    Rows with a null group key are left out (as pandas ``groupby`` does).
    """
    e = _check_edges(edges)
    groups = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    nbins = len(e) - 1
    src = df
    for g in groups:
        src = src.where(F.col(g).isNotNull())
    src = src.select(*groups, bin_index(F.col(value_col), e).alias("_bin"))
    edge_arr = F.array(*[F.lit(v) for v in e])
    per_bin = src.groupBy(*groups, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    # One entry per non-empty bin: bounded by the bin count, not the rows.
    # Groups whose values all fall outside keep an empty map (all zeros).
    entry = F.when(F.col("_bin").isNotNull(), F.struct("_bin", "_n"))
    out = per_bin.groupBy(*groups).agg(
        F.map_from_entries(F.collect_list(entry)).alias("_m")).select(
        *groups,
        F.transform(F.sequence(F.lit(0), F.lit(nbins - 1)),
                    lambda i: F.coalesce(F.col("_m")[i], F.lit(0).cast("long"))).alias("dist"))
    return out.select(*groups, "dist", edge_arr.alias("bins"))


def histogram_long(hist: DataFrame, group_cols: Sequence[str] | str,
                   dist_col: str = "dist", bins_col: str = "bins") -> DataFrame:
    """Dense long form ``(group, bin, left_edge, right_edge, n)`` of :func:`histogram`."""
    groups = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    return hist.select(*groups, F.posexplode(dist_col).alias("bin", "n"), bins_col).select(
        *groups, "bin",
        F.element_at(bins_col, F.col("bin") + 1).alias("left_edge"),
        F.element_at(bins_col, F.col("bin") + 2).alias("right_edge"),
        "n",
    )


# ----------------------------------------------------------------- metrics
def _dsum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v)


def _masses(a: Column, clip: float | None = None) -> Column:
    total = F.nullif(_dsum(F.transform(a, lambda v: v.cast("double"))), F.lit(0.0))
    if clip is None:
        return F.transform(a, lambda v: v.cast("double") / total)
    return F.transform(a, lambda v: F.greatest(v.cast("double"), F.lit(clip)) / total)


def psi(x: Column, y: Column) -> Column:
    terms = F.zip_with(_masses(x, CLIP), _masses(y, CLIP), lambda p, q: (p - q) * F.ln(p / q))
    return _dsum(terms)


def kl_div(x: Column, y: Column) -> Column:
    terms = F.zip_with(_masses(x, CLIP), _masses(y, CLIP), lambda p, q: p * F.ln(p / q))
    return _dsum(terms)


def _rel_entr(a: Column, m: Column) -> Column:
    return F.when(a > 0, a * F.ln(a / m)).otherwise(F.lit(0.0))


def js_distance(x: Column, y: Column) -> Column:
    def term(p, q):
        m = (p + q) / 2
        return _rel_entr(p, m) + _rel_entr(q, m)
    return F.sqrt(_dsum(F.zip_with(_masses(x), _masses(y), term)) / 2)


def wasserstein(x: Column, y: Column) -> Column:
    diffs = F.zip_with(F.array_sort(_masses(x)), F.array_sort(_masses(y)),
                       lambda u, v: F.abs(u - v))
    return _dsum(diffs) / F.size(diffs)


METRICS = {
    "wasserstein_distance": wasserstein,
    "js": js_distance,
    "kl_div": kl_div,
    "psi": psi,
}


def baseline_dist(hist: DataFrame, group_col: str, dist_col: str = "dist",
                  baseline=None) -> Column:
    """Baseline counts as a scalar subquery (computed once, no join).

    Default: the first group in key order (the earliest year).  With a value,
    the group whose key equals it.
    """
    src = hist if baseline is None else hist.where(F.col(group_col) == F.lit(baseline))
    return src.agg(F.min_by(dist_col, group_col)).scalar()


def drift_report(hist: DataFrame, group_col: str, dist_col: str = "dist", baseline=None,
                 metrics: Sequence[str] = tuple(METRICS), materialize: bool = True) -> DataFrame:
    """Every group against the baseline: one column per metric (DOUBLE).

    The histogram is read twice (baseline subquery and main plan), and Spark
    does not share the exchange between them; ``materialize`` therefore writes
    the group-level histogram (groups x bins, small) once to shared storage, so
    the raw data is scanned and aggregated once.  This runs that job eagerly.
    """
    if materialize:
        hist = stage(hist.sparkSession, hist.select(group_col, dist_col), "histogram")
    base = baseline_dist(hist, group_col, dist_col, baseline)
    with_base = hist.select(group_col, dist_col, base.alias("_base"))
    return with_base.select(
        group_col, *[METRICS[m](F.col("_base"), F.col(dist_col)).alias(m) for m in metrics])


def density_series(hist: DataFrame, group_col: str, dist_col: str = "dist",
                   bins_col: str = "bins") -> DataFrame:
    """Per group and bin: left edge and mass ``n / sum(n)`` (the plotted series)."""
    nb = F.size(dist_col)
    return hist.select(
        group_col,
        F.posexplode(F.arrays_zip(
            F.slice(bins_col, 1, nb).alias("left_edge"),
            _masses(F.col(dist_col)).alias("mass"))).alias("bin", "p"),
    ).select(group_col, "bin", F.col("p.left_edge").alias("left_edge"),
             F.col("p.mass").alias("mass"))
