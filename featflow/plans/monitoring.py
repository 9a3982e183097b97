"""Drift queries: per-group histograms and metrics against a baseline group.

Metric outputs are rounded to 9 decimals in the queries (not in the library):
the JVM and C ``ln`` differ in the last bit.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from featflow.operators.drift import density_series, drift_report, histogram, histogram_long
from featflow.plans.fixtures import TEMP_EDGES, YEAR_EDGES, dated_measure, table

WIDE_EDGES = tuple(float(5_000 * i) for i in range(101))


def _year_hist(spark, sf_dir, edges=YEAR_EDGES):
    return histogram(dated_measure(spark, sf_dir), "temp", edges, "year")


def _event_hist(spark, sf_dir):
    return histogram(table(spark, sf_dir, "events"), "value", TEMP_EDGES, "event_type")


def q_hist_by_year(spark, sf_dir):
    """Groups come out in key order, as the per-year histograms did."""
    return _year_hist(spark, sf_dir).orderBy("year")


def q_hist_wide(spark, sf_dir):
    return _year_hist(spark, sf_dir, WIDE_EDGES).select("year", "dist")


def q_hist_dense_long(spark, sf_dir):
    return histogram_long(_event_hist(spark, sf_dir), "event_type")


def q_density_series(spark, sf_dir):
    return density_series(_year_hist(spark, sf_dir), "year")


def _rounded(df, keep):
    return df.select(*[F.col(c) if c in keep else F.round(c, 9).alias(c) for c in df.columns])


def q_drift_report(spark, sf_dir):
    return _rounded(drift_report(_year_hist(spark, sf_dir), "year"), {"year"})


def _one(metric):
    def q(spark, sf_dir):
        out = drift_report(_event_hist(spark, sf_dir), "event_type", metrics=[metric])
        return _rounded(out, {"event_type"})
    q.__name__ = f"q_drift_{metric}"
    return q


QUERIES = {
    "hist_by_year": q_hist_by_year,
    "hist_wide": q_hist_wide,
    "hist_dense_long": q_hist_dense_long,
    "density_series": q_density_series,
    "drift_report": q_drift_report,
    "drift_psi": _one("psi"),
    "drift_kl": _one("kl_div"),
    "drift_js": _one("js"),
    "drift_wasserstein": _one("wasserstein_distance"),
}


# ------------------------------------------------------------ DuckDB twins
def _num(v: float) -> str:
    return repr(float(v))


def _case_bin(v: str, edges) -> str:
    e = [float(x) for x in edges]
    parts = [f"WHEN {v} IS NULL OR isnan({v}) OR {v} < {_num(e[0])} OR {v} > {_num(e[-1])} THEN NULL"]
    for i in range(1, len(e) - 1):
        parts.append(f"WHEN {v} < {_num(e[i])} THEN {i - 1}")
    return f"CASE {' '.join(parts)} ELSE {len(e) - 2} END"


def _hist_sql(src: str, group: str, value: str, edges, name: str = "hist") -> str:
    nb = len(edges) - 1
    counts = ", ".join(f"CAST(count_if(bin = {i}) AS BIGINT)" for i in range(nb))
    bins = ", ".join(_num(x) for x in edges)
    return f"""
{name}_b AS (
  SELECT {group} AS g, {_case_bin('CAST(' + value + ' AS DOUBLE)', edges)} AS bin
  FROM {src} WHERE {group} IS NOT NULL
),
{name} AS (
  SELECT g, [{counts}] AS dist, CAST([{bins}] AS DOUBLE[]) AS bins FROM {name}_b GROUP BY g
)"""


_YEARS_SRC = ("(SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice AS temp "
              "FROM orders) AS dm")


def _metrics_sql(hist: str, group_alias: str, metrics) -> str:
    """Drift of every group against the first group, with list lambdas."""
    exprs = {
        "wasserstein_distance":
            "list_sum(list_transform(range(1, len(d) + 1), "
            "lambda i: abs(list_sort(px)[i] - list_sort(py)[i]))) / len(d)",
        "js":
            "sqrt(list_sum(list_transform(range(1, len(d) + 1), lambda i: "
            "(CASE WHEN px[i] > 0 THEN px[i] * ln(px[i] / ((px[i] + py[i]) / 2)) ELSE 0.0 END) + "
            "(CASE WHEN py[i] > 0 THEN py[i] * ln(py[i] / ((px[i] + py[i]) / 2)) ELSE 0.0 END)"
            ")) / 2)",
        "kl_div":
            "list_sum(list_transform(range(1, len(d) + 1), lambda i: cx[i] * ln(cx[i] / cy[i])))",
        "psi":
            "list_sum(list_transform(range(1, len(d) + 1), "
            "lambda i: (cx[i] - cy[i]) * ln(cx[i] / cy[i])))",
    }
    cols = ", ".join(f"round({exprs[m]}, 9) AS {m}" for m in metrics)
    return f"""
base AS (SELECT arg_min(dist, g) AS bd FROM {hist}),
sums AS (
  SELECT g, dist AS d, bd,
         NULLIF(CAST(list_sum(bd) AS DOUBLE), 0) AS xs,
         NULLIF(CAST(list_sum(dist) AS DOUBLE), 0) AS ys
  FROM {hist}, base
),
masses AS (
  SELECT g, d,
         list_transform(bd, lambda v: CAST(v AS DOUBLE) / xs) AS px,
         list_transform(d, lambda v: CAST(v AS DOUBLE) / ys) AS py,
         list_transform(bd, lambda v: greatest(CAST(v AS DOUBLE), 0.0001) / xs) AS cx,
         list_transform(d, lambda v: greatest(CAST(v AS DOUBLE), 0.0001) / ys) AS cy
  FROM sums
)
SELECT g AS {group_alias}, {cols} FROM masses"""


_ALL = ("wasserstein_distance", "js", "kl_div", "psi")


def _event_metric_sql(metric: str) -> str:
    return (f"WITH {_hist_sql('events', 'event_type', 'value', TEMP_EDGES)}, "
            f"{_metrics_sql('hist', 'event_type', [metric])}")



SQL = {
    "hist_by_year": f"WITH {_hist_sql(_YEARS_SRC, 'year', 'temp', YEAR_EDGES)} "
                    "SELECT g AS year, dist, bins FROM hist",
    "hist_wide": f"WITH {_hist_sql(_YEARS_SRC, 'year', 'temp', WIDE_EDGES)} "
                 "SELECT g AS year, dist FROM hist",
    "hist_dense_long": f"""WITH {_hist_sql('events', 'event_type', 'value', TEMP_EDGES)},
        b AS (SELECT unnest(range(0, {len(TEMP_EDGES) - 1})) AS bin)
        SELECT h.g AS event_type, CAST(b.bin AS INTEGER) AS bin,
               h.bins[b.bin + 1] AS left_edge, h.bins[b.bin + 2] AS right_edge,
               h.dist[b.bin + 1] AS n
        FROM hist h, b""",
    "density_series": f"""WITH {_hist_sql(_YEARS_SRC, 'year', 'temp', YEAR_EDGES)},
        b AS (SELECT unnest(range(0, {len(YEAR_EDGES) - 1})) AS bin)
        SELECT h.g AS year, CAST(b.bin AS INTEGER) AS bin, h.bins[b.bin + 1] AS left_edge,
               CAST(h.dist[b.bin + 1] AS DOUBLE)
                 / NULLIF(CAST(list_sum(h.dist) AS DOUBLE), 0) AS mass
        FROM hist h, b""",
    "drift_report": f"WITH {_hist_sql(_YEARS_SRC, 'year', 'temp', YEAR_EDGES)}, "
                    f"{_metrics_sql('hist', 'year', _ALL)}",
    "drift_psi": _event_metric_sql("psi"),
    "drift_kl": _event_metric_sql("kl_div"),
    "drift_js": _event_metric_sql("js"),
    "drift_wasserstein": _event_metric_sql("wasserstein_distance"),
}
