import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from featflow.operators.windows import (
    dropoff_features_fn,
    pickup_features_fn,
    window_mean_count,
)
from featflow.plans.fixtures import trips
from tests.conftest import SF001


def test_pane_equals_direct_on_trips(spark):
    t = trips(spark, SF001)
    a = pickup_features_fn(t, "tpep_pickup_datetime", None, "2024-01-20")
    b = pickup_features_fn(t, "tpep_pickup_datetime", None, "2024-01-20", method="pane")
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_null_value_and_null_time(spark):
    rows = [(1, dt.datetime(2016, 1, 1, 10, 5), 10.0), (1, dt.datetime(2016, 1, 1, 10, 6), None),
            (1, None, 5.0)]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, v double")
    for method in ("direct", "pane"):
        out = {r["window_end"]: r for r in
               window_mean_count(df, "k", "t", "v", "1 hour", "15 minutes", method).collect()}
        assert len(out) == 4  # null time leaves no window
        r = out[dt.datetime(2016, 1, 1, 10, 15)]
        assert r["mean_value"] == 10.0 and r["n_rows"] == 2


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4 * 3600 * 10**6),
                          st.one_of(st.none(), st.floats(0, 100))), min_size=1, max_size=40))
def test_pane_equals_direct_property(spark, rows):
    base = dt.datetime(2016, 1, 1)
    data = [(k, base + dt.timedelta(microseconds=us), v) for k, us, v in rows]
    df = spark.createDataFrame(data, "k int, t timestamp_ntz, v double")
    a = {(r[0], r[1]): (r[2], r[3]) for r in
         window_mean_count(df, "k", "t", "v", "1 hour", "15 minutes", "direct").collect()}
    b = {(r[0], r[1]): (r[2], r[3]) for r in
         window_mean_count(df, "k", "t", "v", "1 hour", "15 minutes", "pane").collect()}
    assert a.keys() == b.keys()
    for key, (m, n) in a.items():
        m2, n2 = b[key]
        assert n == n2
        assert (m is None and m2 is None) or abs(m - m2) <= 1e-9 * max(1.0, abs(m))


def test_dropoff_weekend_is_of_window_end(spark):
    # A trip on Friday 23:50 New York (04:50 UTC Saturday) falls in the window
    # ending Saturday 00:00 New York, which counts as weekend.
    df = spark.createDataFrame([(1, dt.datetime(2016, 1, 2, 4, 50))],
                               "dropoff_zip int, tpep_dropoff_datetime timestamp_ntz")
    r = dropoff_features_fn(df).collect()[0]
    assert r["ts"] == int(dt.datetime(2016, 1, 2, 5, 0, tzinfo=dt.timezone.utc).timestamp())
    assert r["dropoff_is_weekend"] == 1 and r["count_trips_window_30m_dropoff_zip"] == 1
    assert r["yyyy_mm"] == "2016-01"


def test_feature_plans_have_no_python(spark):
    t = trips(spark, SF001)
    for df in (pickup_features_fn(t), pickup_features_fn(t, method="pane"), dropoff_features_fn(t)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_user_feature_function_plugs_in(spark):
    from pyspark.sql import functions as F

    from featflow.operators.windows import apply_feature_fn

    def max_fare_fn(df, ts_column=None, start_date=None, end_date=None):
        from featflow.functions.times import filter_df_by_ts
        df = filter_df_by_ts(df, ts_column, start_date, end_date)
        return df.groupBy(F.col("pickup_zip").alias("zip")).agg(F.max("fare_amount").alias("mx"))

    out = apply_feature_fn(trips(spark, SF001), max_fare_fn, "tpep_pickup_datetime",
                           None, "2024-01-20")
    want = trips(spark, SF001).where(F.col("tpep_pickup_datetime") < F.lit("2024-01-20")
                                     .cast("timestamp_ntz")).select("pickup_zip").distinct().count()
    assert out.count() == want and out.columns == ["zip", "mx"]


def test_sizing_helpers(spark):
    from featflow.session import cluster_conf, spread
    conf = cluster_conf(100 * 2**40, 1000, 8)
    assert conf["spark.sql.shuffle.partitions"] == "819200"
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = spark.range(10).coalesce(1)
    assert spread(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
