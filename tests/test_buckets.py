import uuid

import pytest
from pyspark.sql import functions as F

from featflow.operators.lookup import FeatureLookup, apply_lookups
from featflow.plans import taxi
from featflow.plans.fixtures import trips
from featflow.sources import store

SF = "/root/testdata/sf0.001"
CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
        "spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}


@pytest.fixture
def settings(spark):
    before = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _table(spark, rows, buckets=4, **kw):
    name = f"bucket_test.t_{uuid.uuid4().hex[:10]}"
    df = spark.createDataFrame(rows, "k int, t int, v double, w string")
    return name, store.create_table(spark, name, ["k", "t"], df=df, bucket_count=buckets, **kw)


def _above_scans(plan):
    """Operator names from each feature-table scan up to its join."""
    out = []

    def walk(node, path):
        name = node.nodeName()
        if "Join" in name:
            path = []
        if name.startswith("Scan") and "features" in node.toString():
            out.append(path)
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), [*path, name])

    walk(plan, [])
    return out


def test_lookups_move_and_sort_no_table(spark, settings):
    pn, dn = taxi.build_feature_tables(spark, SF, buckets=16)
    base = taxi.rounded_taxi_data(trips(spark, SF))
    out = apply_lookups(spark, base, taxi.lookups(pn, dn))
    plan = out._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("SortMergeJoin") == 2 and "Broadcast" not in text
    found = _above_scans(plan)
    assert len(found) == 2, text
    for path in found:
        assert not any("Exchange" in n or n == "Sort" for n in path), path
    # The base moves once per lookup, into the table's buckets.
    assert text.count("Exchange hashpartitioning") == 2 and ", 16)" in text
    p2, d2 = taxi.build_feature_tables(spark, SF)
    want = apply_lookups(spark, base, taxi.lookups(p2, d2))
    assert sorted(map(repr, out.collect())) == sorted(map(repr, want.collect()))


def test_one_sorted_file_per_bucket_and_merges_keep_it(spark):
    rows = [(i % 37, i, float(i), str(i)) for i in range(500)]
    name, info = _table(spark, rows)
    assert info.bucket_count == 4 and info.partition_columns == ()
    for _ in range(2):
        files = spark.table(name).inputFiles()
        assert len(files) == 4
        for f in files:
            keys = [tuple(r) for r in spark.read.parquet(f).select("k", "t").collect()]
            assert keys == sorted(keys)
        store.write_table(spark, name, spark.createDataFrame(
            [(1, 1, -1.0, "new"), (99, 99, 9.0, None)], "k int, t int, v double, w string"))
    got = {(r.k, r.t): (r.v, r.w) for r in spark.table(name).collect()}
    assert len(got) == 501 and got[1, 1] == (-1.0, "new") and got[99, 99] == (9.0, None)
    # A subset of the columns keeps the others.
    store.write_table(spark, name, spark.createDataFrame([(1, 1, 5.0)], "k int, t int, v double"))
    assert spark.table(name).where("k = 1 AND t = 1").first()[2:] == (5.0, "new")
    assert [t.name for t in spark.catalog.listTables("bucket_test") if not t.isTemporary] \
        .count(name.split(".")[1]) == 1
    assert len(spark.catalog.listTables("bucket_test")) == 1  # no scratch table is left
    assert store.vacuum(spark, name, 0) >= 3 and spark.table(name).count() == 501
    store.drop_table(spark, name)


def test_keys_are_checked_and_empty_tables_work(spark):
    with pytest.raises(store.FeatureTableError):
        _table(spark, [(1, 1, 0.0, ""), (1, 1, 1.0, "")])
    with pytest.raises(store.FeatureTableError):
        _table(spark, [(1, 1, 0.0, "")], partition_columns=["w"])
    name, _ = _table(spark, [])
    base = spark.createDataFrame([(1, 2), (None, 3)], "a int, b int")
    out = apply_lookups(spark, base, [FeatureLookup(name, ["v"], ["a", "b"])])
    assert out.where(F.col("v").isNull()).count() == 2
    store.write_table(spark, name, spark.createDataFrame([(1, 2, 3.0, "x")],
                                                         "k int, t int, v double, w string"))
    assert out.sparkSession.table(name).count() == 1
    store.drop_table(spark, name)
