import uuid

import pytest

from featflow.operators.lookup import FeatureLookup, LookupError_, create_training_set
from featflow.sources import store


def _table(spark, rows, feats="f1 double, f2 int"):
    name = f"featflow_test.l_{uuid.uuid4().hex[:8]}"
    df = spark.createDataFrame(rows, f"zip int, ts int, yyyy_mm string, {feats}")
    store.create_table(spark, name, ["zip", "ts"], df=df, partition_columns="yyyy_mm")
    return name


def test_left_lookup_keeps_every_row(spark):
    t = _table(spark, [(1, 100, "2016-01", 1.5, 3)])
    base = spark.createDataFrame([(1, 100, 9.0), (1, 200, 8.0), (None, 100, 7.0)],
                                 "pickup_zip int, rounded int, y double")
    ts = create_training_set(spark, base, [FeatureLookup(t, ["f1", "f2"], ["pickup_zip", "rounded"])],
                             label="y", exclude_columns=["rounded"])
    rows = sorted(ts.load_df().collect(), key=lambda r: -r["y"])
    assert [r["f1"] for r in rows] == [1.5, None, None]
    assert "rounded" not in ts.load_df().columns


def test_same_feature_twice_is_an_error(spark):
    t1 = _table(spark, [(1, 100, "2016-01", 1.5, 3)])
    t2 = _table(spark, [(1, 100, "2016-01", 2.5, 4)])
    base = spark.createDataFrame([(1, 100, 9.0)], "z int, t int, y double")
    ts = create_training_set(spark, base, [FeatureLookup(t1, ["f1"], ["z", "t"]),
                                           FeatureLookup(t2, ["f1"], ["z", "t"])], label="y")
    with pytest.raises(LookupError_):
        ts.load_df()


def test_key_arity_checked(spark):
    t = _table(spark, [(1, 100, "2016-01", 1.5, 3)])
    base = spark.createDataFrame([(1, 100, 9.0)], "z int, t int, y double")
    ts = create_training_set(spark, base, [FeatureLookup(t, ["f1"], ["z"])], label="y")
    with pytest.raises(LookupError_):
        ts.load_df()


def test_partition_pruned_lookup(spark):
    import datetime as dt
    name = f"featflow_test.p_{uuid.uuid4().hex[:8]}"
    jan = int(dt.datetime(2016, 1, 10, tzinfo=dt.timezone.utc).timestamp())
    feb = int(dt.datetime(2016, 2, 10, tzinfo=dt.timezone.utc).timestamp())
    df = spark.createDataFrame([(1, jan, "2016-01", 1.0), (1, feb, "2016-02", 2.0)],
                               "zip int, ts int, yyyy_mm string, f double")
    store.create_table(spark, name, ["zip", "ts"], df=df, partition_columns="yyyy_mm",
                       partition_time_key="ts")
    base = spark.createDataFrame([(1, feb, 0.0), (1, feb + 60, 0.0)], "z int, k int, y double")
    from featflow.operators.lookup import lookup_features
    lk = FeatureLookup(name, ["f"], ["z", "k"])
    out = lookup_features(spark, base, lk)
    assert sorted(map(tuple, out.collect())) == [(1, feb, 0.0, 2.0), (1, feb + 60, 0.0, None)]
    # A selective base prunes the months while the query runs.
    path = f"{store.fresh_path(spark, 'base')}"
    base.write.parquet(path)
    some = lookup_features(spark, spark.read.parquet(path).where("y < 1"), lk)
    assert "dynamicpruningexpression(yyyy_mm" in some._jdf.queryExecution().executedPlan().toString()


def test_wide_keys_are_a_miss_not_an_error(spark):
    name = f"featflow_test.w_{uuid.uuid4().hex[:8]}"
    df = spark.createDataFrame([(5_000_000_000, 1.0), (7, 2.0)], "k long, f double")
    store.create_table(spark, name, ["k"], df=df)
    base = spark.createDataFrame([(7, "a"), (8, "b")], "z int, x string")
    ts = create_training_set(spark, base, [FeatureLookup(name, ["f"], ["z"])], label=None)
    assert sorted(map(tuple, ts.load_df().collect())) == [(7, "a", 2.0), (8, "b", None)]


def test_hot_key_lookup_without_broadcast(spark):
    """A third of the base on one key: sort-merge path, AQE splits the hot partition."""
    from pyspark.sql import functions as F

    from featflow.operators.lookup import lookup_features
    name = _table(spark, [(k, 100, "2016-01", float(k), k) for k in range(50)])
    n = 30000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise((F.col("id") % 50).cast("int")).alias("z"),
        F.lit(100).alias("t"), F.col("id"))
    lk = FeatureLookup(name, ["f1"], ["z", "t"])
    want = lookup_features(spark, base, lk).groupBy("z").agg(F.sum("f1"), F.count("*"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        joined = lookup_features(spark, base, lk)
        got = joined.groupBy("z").agg(F.sum("f1"), F.count("*"))
        assert sorted(got.collect()) == sorted(want.collect())
        assert joined.count() == n
        qe = joined._jdf.queryExecution()
        qe.toRdd().count()  # run this plan so AQE finalises it
        plan = qe.executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
