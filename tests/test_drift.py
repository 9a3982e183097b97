import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from featflow.operators import drift
from featflow.plans.fixtures import TEMP_EDGES


# Reference formulas in numpy (the published definitions).
def np_psi(x, y):
    x = np.asarray(x, float); y = np.asarray(y, float)
    a = np.clip(x, 1e-4, None) / x.sum(); b = np.clip(y, 1e-4, None) / y.sum()
    return float(np.sum((a - b) * np.log(a / b)))


def np_kl(x, y):
    x = np.asarray(x, float); y = np.asarray(y, float)
    a = np.clip(x, 1e-4, None) / x.sum(); b = np.clip(y, 1e-4, None) / y.sum()
    return float(np.sum(a * np.log(a / b)))


def np_js(x, y):
    p = np.asarray(x, float) / np.sum(x); q = np.asarray(y, float) / np.sum(y)
    m = (p + q) / 2

    def rel(a, b):
        return np.where(a > 0, a * np.log(np.where(a > 0, a, 1) / np.where(b > 0, b, 1)), 0.0)
    return float(np.sqrt((rel(p, m).sum() + rel(q, m).sum()) / 2))


def np_wass(x, y):
    u = np.sort(np.asarray(x, float) / np.sum(x)); v = np.sort(np.asarray(y, float) / np.sum(y))
    return float(np.mean(np.abs(u - v)))


def test_histogram_edges_like_numpy(spark):
    vals = [33.0, 46.0, 96.0, 96.1, 32.9, float("nan"), None, 45.999, 40.0]
    df = spark.createDataFrame([("a", v) for v in vals], "g string, v double")
    got = drift.histogram(df, "v", TEMP_EDGES, "g").collect()[0]["dist"]
    finite = np.array([v for v in vals if v is not None and not math.isnan(v)])
    want, _ = np.histogram(finite, bins=TEMP_EDGES)
    assert list(got) == list(want)


def test_wide_path_equals_narrow(spark):
    edges = [float(i) for i in range(0, 101)]
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    wide = {r[0]: list(r[1]) for r in drift.histogram(ev, "value", edges, "event_type").collect()}
    for g, dist in wide.items():
        vals = np.array([r[0] for r in ev.where(F.col("event_type") == g).select("value").collect()])
        want, _ = np.histogram(vals, bins=edges)
        assert dist == list(want)


def test_empty_group_gives_null_metrics(spark):
    df = spark.createDataFrame([(1, 50.0), (1, 60.0), (2, 1000.0)], "year int, v double")
    h = drift.histogram(df, "v", TEMP_EDGES, "year")
    rows = {r["year"]: r for r in drift.drift_report(h, "year").collect()}
    assert rows[1]["psi"] == 0.0 and rows[1]["js"] == 0.0 and rows[1]["wasserstein_distance"] == 0.0
    assert all(rows[2][m] is None for m in drift.METRICS)


def test_density_series(spark):
    df = spark.createDataFrame([(1, 34.0), (1, 41.0), (1, 42.0)], "year int, v double")
    rows = drift.density_series(drift.histogram(df, "v", TEMP_EDGES, "year"), "year").collect()
    assert len(rows) == 10 and rows[0]["left_edge"] == 33.0
    assert abs(rows[0]["mass"] - 1 / 3) < 1e-12 and abs(rows[1]["mass"] - 2 / 3) < 1e-12


counts = st.lists(st.integers(0, 50), min_size=10, max_size=10).filter(lambda v: sum(v) > 0)


@settings(max_examples=20, deadline=None)
@given(counts, counts)
def test_metrics_match_numpy_and_properties(spark, x, y):
    df = spark.createDataFrame([(x, y)], "x array<bigint>, y array<bigint>")
    r = df.select(*[fn(F.col("x"), F.col("y")).alias(n) for n, fn in drift.METRICS.items()],
                  drift.psi(F.col("y"), F.col("x")).alias("psi_rev")).collect()[0]
    assert math.isclose(r["psi"], np_psi(x, y), rel_tol=1e-9, abs_tol=1e-12)
    assert math.isclose(r["kl_div"], np_kl(x, y), rel_tol=1e-9, abs_tol=1e-12)
    assert math.isclose(r["js"], np_js(x, y), rel_tol=1e-9, abs_tol=1e-12)
    assert math.isclose(r["wasserstein_distance"], np_wass(x, y), rel_tol=1e-9, abs_tol=1e-12)
    assert r["psi"] >= -1e-12 and math.isclose(r["psi"], r["psi_rev"], rel_tol=1e-9, abs_tol=1e-12)
    assert -1e-12 <= r["js"] <= math.sqrt(math.log(2)) + 1e-12


def test_plan_is_native(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    h = drift.histogram(df.withColumn("y", F.year("o_orderdate")), "o_totalprice",
                        [0.0, 1e5, 2e5, 5e5], "y")
    plan = drift.drift_report(h, "y")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
