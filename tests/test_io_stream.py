import uuid

from featflow.operators.windows import pickup_features_fn
from featflow.plans.fixtures import trips, trips_from_events
from featflow.session import fresh_path
from featflow.sources import io, store
from featflow.streaming.refresh import refresh_feature_table

SF = "/root/testdata/sf0.001"


def test_delimited_round_trip(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_quantity", "l_tax")
    path = fresh_path(spark, "csv-test")
    io.write_delimited(li, path, sep=";")
    back = io.read_delimited(spark, path, sep=";", schema="l_orderkey bigint, l_quantity double, l_tax double")
    assert back.exceptAll(li).count() == 0 and li.exceptAll(back).count() == 0
    inferred = io.read_delimited(spark, path, sep=";", infer=True)
    assert dict(inferred.dtypes)["l_quantity"] == "double"
    assert io.preview(back, 5).count() == 5
    assert io.sample_range(trips(spark, SF), "tpep_pickup_datetime", "2024-01-02", "2024-01-03").count() > 0


def test_streaming_refresh_equals_batch(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    batch = pickup_features_fn(trips_from_events(events))
    name = f"featflow_test.s_{uuid.uuid4().hex[:8]}"
    store.create_table(spark, name, ["zip", "ts"], schema=batch.schema, partition_columns="yyyy_mm")
    stream = (spark.readStream.format("parquet").schema(events.schema)
              .option("pathGlobFilter", "events.parquet").load(SF))
    q = refresh_feature_table(spark, trips_from_events(stream), name, "pickup")
    q.awaitTermination()
    got = spark.table(name).select(*batch.columns)
    assert got.count() == batch.count()
    assert got.exceptAll(batch).count() == 0
