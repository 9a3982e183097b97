import uuid

import pytest
from pyspark.sql import functions as F

from featflow.sources import store

SCHEMA = "zip int, ts int, yyyy_mm string, a double, b int"


def _name():
    return f"featflow_test.t_{uuid.uuid4().hex[:8]}"


def _rows(spark, name):
    return sorted(tuple(r) for r in spark.table(name).select("zip", "ts", "yyyy_mm", "a", "b").collect())


def test_create_rejects_bad_keys(spark):
    dup = spark.createDataFrame([(1, 1, "2016-01", 1.0, 1), (1, 1, "2016-01", 2.0, 2)], SCHEMA)
    with pytest.raises(store.FeatureTableError, match="duplicate"):
        store.create_table(spark, _name(), ["zip", "ts"], df=dup, partition_columns="yyyy_mm")
    nul = spark.createDataFrame([(None, 1, "2016-01", 1.0, 1)], SCHEMA)
    with pytest.raises(store.FeatureTableError, match="null"):
        store.create_table(spark, _name(), ["zip", "ts"], df=nul, partition_columns="yyyy_mm")


def test_merge_upsert_and_idempotence(spark):
    name = _name()
    first = spark.createDataFrame(
        [(1, 10, "2016-01", 1.0, 1), (2, 20, "2016-01", 2.0, 2), (3, 30, "2016-02", 3.0, 3)], SCHEMA)
    store.create_table(spark, name, ["zip", "ts"], df=first, partition_columns="yyyy_mm",
                       description="d")
    batch = spark.createDataFrame([(2, 20, "2016-01", 20.0, 20), (4, 40, "2016-01", 4.0, 4)], SCHEMA)
    store.write_table(spark, name, batch, mode="merge")
    want = [(1, 10, "2016-01", 1.0, 1), (2, 20, "2016-01", 20.0, 20), (3, 30, "2016-02", 3.0, 3),
            (4, 40, "2016-01", 4.0, 4)]
    assert _rows(spark, name) == want
    store.write_table(spark, name, batch, mode="merge")
    assert _rows(spark, name) == want


def test_merge_column_subset_keeps_old_values(spark):
    name = _name()
    first = spark.createDataFrame([(1, 10, "2016-01", 1.0, 1)], SCHEMA)
    store.create_table(spark, name, ["zip", "ts"], df=first, partition_columns="yyyy_mm")
    sub = spark.createDataFrame([(1, 10, "2016-01", 7), (5, 50, "2016-01", 5)],
                                "zip int, ts int, yyyy_mm string, b int")
    store.write_table(spark, name, sub)
    assert _rows(spark, name) == [(1, 10, "2016-01", 1.0, 7), (5, 50, "2016-01", None, 5)]


def test_merge_rejects_duplicate_incoming(spark):
    name = _name()
    store.create_table(spark, name, ["zip", "ts"],
                       df=spark.createDataFrame([(1, 10, "2016-01", 1.0, 1)], SCHEMA),
                       partition_columns="yyyy_mm")
    dup = spark.createDataFrame([(2, 20, "2016-01", 1.0, 1), (2, 20, "2016-01", 2.0, 2)], SCHEMA)
    with pytest.raises(store.FeatureTableError):
        store.write_table(spark, name, dup)


def test_tags_and_metadata(spark):
    name = _name()
    store.create_table(spark, name, ["zip", "ts"],
                       df=spark.createDataFrame([(1, 10, "2016-01", 1.0, 1)], SCHEMA),
                       partition_columns="yyyy_mm", description="Taxi Fares")
    store.set_feature_table_tag(spark, name, "isDemo", "True")
    t = store.get_table(spark, name)
    assert t.primary_keys == ("zip", "ts") and t.partition_columns == ("yyyy_mm",)
    assert t.description == "Taxi Fares" and t.tags == {"isDemo": "True"}
    assert set(t.features) == {"a", "b"}
    info = store.table_info(spark, name).collect()[0]
    assert info["tags"] == {"isDemo": "True"}
    # SQL users see the same table.
    assert spark.sql(f"SELECT SUM(b) AS s FROM {name} WHERE a IS NOT NULL").collect()[0][0] == 1


def test_empty_table_from_schema(spark):
    from pyspark.sql.types import StructType
    name = _name()
    schema = StructType.fromDDL(SCHEMA)
    store.create_table(spark, name, ["zip", "ts"], schema=schema, partition_columns="yyyy_mm")
    assert spark.table(name).count() == 0
    store.write_table(spark, name, spark.createDataFrame([(1, 10, "2016-01", 1.0, 1)], SCHEMA))
    assert spark.table(name).where(F.col("zip") == 1).count() == 1


def test_overwrite_replaces_all_partitions_and_merge_after_swap(spark):
    name = _name()
    first = spark.createDataFrame(
        [(1, 10, "2016-01", 1.0, 1), (3, 30, "2016-02", 3.0, 3)], SCHEMA)
    store.create_table(spark, name, ["zip", "ts"], df=first, partition_columns="yyyy_mm")
    store.write_table(spark, name, spark.createDataFrame([(1, 10, "2016-01", 5.0, 5)], SCHEMA))
    store.write_table(spark, name, spark.createDataFrame([(2, 20, "2016-01", 2.0, 2)], SCHEMA))
    assert _rows(spark, name) == [(1, 10, "2016-01", 5.0, 5), (2, 20, "2016-01", 2.0, 2),
                                  (3, 30, "2016-02", 3.0, 3)]
    store.write_table(spark, name, spark.createDataFrame([(7, 70, "2016-03", 7.0, 7)], SCHEMA),
                      mode="overwrite")
    assert _rows(spark, name) == [(7, 70, "2016-03", 7.0, 7)]
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    assert parts == ["yyyy_mm=2016-03"]
    stats = spark.table(name)._jdf.queryExecution().optimizedPlan().stats()
    assert stats.sizeInBytes() < 10 << 20  # usable for broadcast checks


def test_partitions_mode_replaces_only_the_partitions_it_writes(spark):
    name = _name()
    first = spark.createDataFrame([(1, 10, "2016-01", 1.0, 1), (2, 20, "2016-01", 2.0, 2),
                                   (3, 30, "2016-02", 3.0, 3)], SCHEMA)
    store.create_table(spark, name, ["zip", "ts"], df=first, partition_columns="yyyy_mm")
    before = {f for f in spark.table(name).inputFiles() if "2016-02" in f}
    rows = spark.createDataFrame([(7, 70, "2016-01", 7.0, 7), (8, 80, "2016-03", 8.0, 8)], SCHEMA)
    for _ in range(2):  # the same rows again change nothing
        store.write_table(spark, name, rows, mode="partitions")
        assert _rows(spark, name) == [(3, 30, "2016-02", 3.0, 3), (7, 70, "2016-01", 7.0, 7),
                                      (8, 80, "2016-03", 8.0, 8)]
    assert before <= set(spark.table(name).inputFiles())
    store.write_table(spark, name, rows.limit(0), mode="partitions")
    assert spark.table(name).count() == 3
    with pytest.raises(store.FeatureTableError):
        store.write_table(spark, name, rows.unionByName(rows), mode="partitions")
    with pytest.raises(store.FeatureTableError):
        store.write_table(spark, name, rows.drop("ts"), mode="partitions")
    assert spark.table(name).count() == 3


TYPED = [
    ("boolean", ["true", "false", "true"]),
    ("date", ["DATE'2024-01-01'", "DATE'2024-02-01'", "DATE'2024-01-01'"]),
    ("timestamp", ["TIMESTAMP'2024-01-01 00:00:00.25'", "TIMESTAMP'2024-03-10 02:30:00'",
                   "TIMESTAMP'2024-01-01 00:00:00.25'"]),
    ("double", ["1e-5D", "2.5D", "1e-5D"]),
    ("string", ["'a b/c=%'", "''", "'a b/c=%'"]),
    ("string", ["'x'", "null", "'x'"]),
    ("int", ["7", "-1", "7"]),
]


@pytest.mark.parametrize("kind,values", TYPED)
@pytest.mark.parametrize("of_key", [True, False])
def test_typed_partitions_lose_nothing(spark, kind, values, of_key):
    """Merge and overwrite for partition values of every kind."""
    name = _name()

    def frame(rows):
        return spark.sql(" UNION ALL ".join(
            f"SELECT {k} AS k, '{v}' AS v, CAST({p} AS {kind}) AS p" for k, v, p in rows))

    def rows():
        return sorted((r.k, r.v) for r in spark.table(name).collect())

    a, b, _ = values
    store.create_table(spark, name, ["k"], df=frame([(1, "one", a), (2, "two", b)]),
                       partition_columns="p", partition_of_key=of_key)
    assert rows() == [(1, "one"), (2, "two")]
    store.write_table(spark, name, frame([(1, "new", a), (3, "three", b)]))
    assert rows() == [(1, "new"), (2, "two"), (3, "three")]
    if not of_key:  # a key moves to another partition, and one partition empties
        store.write_table(spark, name, frame([(1, "moved", b)]))
        assert rows() == [(1, "moved"), (2, "two"), (3, "three")]
    assert spark.table(name).where(f"p <=> CAST(nullif(CAST({b} AS string), '') AS {kind})").count() >= 2
    store.write_table(spark, name, frame([(9, "nine", b)]), mode="overwrite")
    assert rows() == [(9, "nine")]
    store.write_table(spark, name, frame([(9, "nine", b)]).limit(0), mode="overwrite")
    assert rows() == []


def test_replaced_files_outlive_readers_until_vacuum(spark):
    name = _name()
    first = spark.createDataFrame([(1, 10, "2016-01", 1.0, 1), (2, 20, "2016-02", 2.0, 2)], SCHEMA)
    store.create_table(spark, name, ["zip", "ts"], df=first, partition_columns="yyyy_mm")
    old = spark.table(name)
    files = old.inputFiles()
    store.write_table(spark, name, spark.createDataFrame([(1, 10, "2016-01", 5.0, 5)], SCHEMA))
    assert spark.read.parquet(*files).count() == 2  # a running reader still finds its files
    assert store.vacuum(spark, name) == 0
    assert store.vacuum(spark, name, retention_s=-60) == 1
    assert _rows(spark, name) == [(1, 10, "2016-01", 5.0, 5), (2, 20, "2016-02", 2.0, 2)]


def test_merge_leaves_no_staged_files(spark):
    import os

    from featflow.session import shared_root
    name = _name()
    store.create_table(spark, name, ["zip", "ts"], partition_columns="yyyy_mm",
                       df=spark.createDataFrame([(1, 10, "2016-01", 1.0, 1)], SCHEMA))
    folder = f"{shared_root(spark)}/featflow"
    before = set(os.listdir(folder))
    store.write_table(spark, name, spark.createDataFrame([(1, 10, "2016-01", 5.0, 5)], SCHEMA))
    assert set(os.listdir(folder)) == before


def test_unpartitioned_merge_and_overwrite(spark):
    name = _name()
    df = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    store.create_table(spark, name, ["k"], df=df)
    store.write_table(spark, name, spark.createDataFrame([(2, 5.0), (3, 3.0)], "k int, v double"))
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, 1.0), (2, 5.0), (3, 3.0)]
    store.write_table(spark, name, spark.createDataFrame([(4, 4.0)], "k int, v double"), mode="overwrite")
    assert [tuple(r) for r in spark.table(name).collect()] == [(4, 4.0)]
    assert store.vacuum(spark, name, retention_s=-60) == 2


def test_subset_merge_reads_touched_partitions_only(spark):
    name = _name()
    first = spark.createDataFrame([(1, 10, "2016-01", 1.0, 1), (2, 20, "2016-02", 2.0, 2)], SCHEMA)
    store.create_table(spark, name, ["zip", "ts"], df=first, partition_columns="yyyy_mm")
    plans = []
    original = store._replace
    try:
        store._replace = lambda s, n, frame, *a: plans.append(frame.inputFiles()) or original(
            s, n, frame, *a)
        store.write_table(spark, name, spark.createDataFrame([(1, 10, "2016-01", 7)],
                                                             "zip int, ts int, yyyy_mm string, b int"))
    finally:
        store._replace = original
    assert any("2016-01" in f for f in plans[0]) and not any("2016-02" in f for f in plans[0])
    assert _rows(spark, name) == [(1, 10, "2016-01", 1.0, 7), (2, 20, "2016-02", 2.0, 2)]


def test_cluster_sessions_need_a_shared_folder():
    from featflow.session import shared_root

    class Conf:
        def __init__(self, **kv):
            self.kv = kv

        def get(self, key, default=None):
            return self.kv.get(key, default)

    class Session:
        conf = Conf(**{"spark.master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session)
    Session.conf = Conf(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///x/"})
    assert shared_root(Session) == "hdfs:///x"
