"""Streaming refresh of the pickup feature table from the events file."""

from __future__ import annotations

import uuid

from featflow.operators.windows import pickup_features_fn
from featflow.plans.fixtures import trips_from_events
from featflow.plans.taxi import DB, SQL as TAXI_SQL
from featflow.sources import store
from featflow.streaming.refresh import refresh_feature_table


def q_stream_pickup_features(spark, sf_dir):
    """Stream the events file through the pickup feature group into a table."""
    events_schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = (spark.readStream.format("parquet").schema(events_schema)
              .option("pathGlobFilter", "events.parquet").load(sf_dir))
    trips = trips_from_events(stream)
    empty = pickup_features_fn(trips_from_events(spark.read.parquet(f"{sf_dir}/events.parquet")))
    name = f"{DB}.stream_pickup_features_{uuid.uuid4().hex[:10]}"
    store.create_table(spark, name, ["zip", "ts"], schema=empty.schema,
                       partition_columns="yyyy_mm", description="Streaming pickup features")
    q = refresh_feature_table(spark, trips, name, "pickup", watermark="2 hours")
    q.awaitTermination()
    return spark.table(name)


QUERIES = {"stream_pickup_features": q_stream_pickup_features}

# One micro-batch holds the whole file, so the table equals the batch features.
SQL = {"stream_pickup_features": TAXI_SQL["pickup_features"]}
