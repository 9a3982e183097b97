import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from featflow.operators import quantiles
from featflow.operators.quantiles import exact_quantiles
from featflow.operators.treeshap import shap_summary

P = [0.0, 0.01, 0.25, 0.5, 0.731, 0.99, 1.0]
BIG = 1.7976931348623157e308


def _frame(spark, **columns):
    rows = list(zip(*columns.values()))
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in columns)).repartition(3)


@pytest.mark.parametrize("bins", [2, 7, 1024])
def test_equals_sorting(spark, bins):
    rng = np.random.default_rng(3)
    n = 501
    columns = {
        "normal": rng.normal(size=n), "ties": rng.integers(0, 3, n).astype(float),
        "heavy.tail": np.exp(rng.normal(size=n) * 12), "one": np.full(n, 2.5),
        "outlier": np.r_[rng.normal(size=n - 1), BIG],
    }
    df = _frame(spark, **{c: v.tolist() for c, v in columns.items()})
    got = exact_quantiles(df, list(columns), P, bins)
    for c, v in columns.items():
        assert np.allclose(got[c], np.quantile(v, P), rtol=1e-14, atol=0), c


def test_range_wider_than_a_double(spark):
    v = [-BIG, -BIG / 3, -1.0, 0.0, 5e-324, 1e-300, 2.0, BIG / 2, BIG]
    at = [i / 8 for i in range(9)]
    assert exact_quantiles(_frame(spark, v=v), ["v"], at, 4) == {"v": sorted(v)}


def test_defined_results(spark):
    inf, nan = math.inf, math.nan
    df = _frame(spark, a=[None, 1.0, 3.0, nan], b=[None, None, nan, None],
                c=[-inf, inf, 1.0, inf], d=[-inf, -inf, -inf, None])
    got = exact_quantiles(df, ["a", "b", "c", "d"], [0.0, 0.5, 1.0])
    assert got == {"a": [1.0, 2.0, 3.0], "b": [None] * 3, "c": [-inf, inf, inf],
                   "d": [-inf] * 3}
    assert exact_quantiles(df.limit(0), ["a"], [0.5]) == {"a": [None]}
    assert exact_quantiles(df, [], [0.5]) == {}
    with pytest.raises(ValueError):
        exact_quantiles(df, ["a"], [1.5])


def test_rows_of_a_task_are_bounded(spark, monkeypatch):
    """A histogram ships cells, not values: far fewer rows than distinct values."""
    seen = []
    place = quantiles._place
    monkeypatch.setattr(quantiles, "_place", lambda ranks, cells, *a: (
        seen.append(len(cells)), place(ranks, cells, *a))[1])
    df = spark.range(200_000).select(F.xxhash64("id").cast("double").alias("v"))
    got = exact_quantiles(df, ["v"], [0.5], bins=64)["v"][0]
    assert got == df.agg(F.percentile("v", 0.5)).first()[0]
    assert max(seen) <= 64 and len(seen) <= 6


def test_summary_has_no_percentile_reducer(spark):
    df = spark.createDataFrame([(0.5, -1.0, None), (-2.0, 0.0, None), (3.0, 0.25, None)],
                               "a double, b double, c double")
    rows = {r["feature"]: r for r in shap_summary(df, ["a", "b", "c"]).collect()}
    assert rows["a"]["abs_quartiles"] == [1.25, 2.0, 2.5] and rows["a"]["rank"] == 1
    assert rows["b"]["abs_quartiles"] == [0.125, 0.25, 0.625]
    assert rows["c"]["abs_quartiles"] is None and rows["c"]["mean_abs_shap"] is None
    assert shap_summary(df.limit(0), ["a"]).count() == 0 or \
        shap_summary(df.limit(0), ["a"]).first()["abs_quartiles"] is None
