"""Keep a feature table current from a stream of trips.

``readStream`` -> watermark on the event time -> the same ``window()``
grouping as the batch feature functions, as a stateful streaming aggregation
in *update* mode.  Each micro-batch carries the full, current aggregate of
every window it changed, so upserting it into the feature table by key
(``write_table(mode="merge")`` in ``foreachBatch``) is exact: a window that
grows over several batches is simply replaced by its newer value.  Events
later than the watermark are dropped by Spark and their windows keep the
value they had.  State and progress live in the checkpoint folder on shared
storage, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from featflow.functions.times import as_instant, dtype_of
from featflow.operators.windows import dropoff_features_fn, pickup_features_fn
from featflow.session import fresh_path
from featflow.sources import store

FEATURE_FNS: dict[str, tuple[Callable[..., DataFrame], str]] = {
    "pickup": (pickup_features_fn, "tpep_pickup_datetime"),
    "dropoff": (dropoff_features_fn, "tpep_dropoff_datetime"),
}


def streaming_features(trips_stream: DataFrame, kind: str = "pickup",
                       watermark: str = "2 hours") -> DataFrame:
    """Window features of a streaming trips frame (update-mode aggregate)."""
    fn, ts_col = FEATURE_FNS[kind]
    # Watermarks need an instant; NTZ event times are read as UTC.
    stream = trips_stream.withColumn(ts_col, as_instant(ts_col, dtype_of(trips_stream, ts_col)))
    # Streams take one aggregation only, so windows are built directly.
    how = {"method": "direct"} if kind == "pickup" else {}
    return fn(stream.withWatermark(ts_col, watermark), **how)


def refresh_feature_table(spark: SparkSession, trips_stream: DataFrame, table_name: str,
                          kind: str = "pickup", watermark: str = "2 hours",
                          checkpoint: str | None = None,
                          available_now: bool = True,
                          processing_time: str | None = None) -> StreamingQuery:
    """Start the stream that upserts window features into ``table_name``."""
    feats = streaming_features(trips_stream, kind, watermark)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        # Update mode emits each (key, window) at most once per micro-batch,
        # so the batch's keys are unique by construction: skip that shuffle.
        store.write_table(batch.sparkSession, table_name, batch, mode="merge", validate=False)

    writer = (feats.writeStream.outputMode("update").foreachBatch(upsert)
              .option("checkpointLocation", checkpoint or fresh_path(spark, "stream-cp", kind)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
