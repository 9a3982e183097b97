"""Stand-in inputs derived from the test tables by Spark.

The reference works on a taxi-trips table, a wine-quality CSV, a temperature
CSV and a run log; none ships with it.  Each stand-in below is a projection of
a given table, so its size grows with the table.  The DuckDB twins live next
to them (``*_SQL``) so the oracle queries derive identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- trips
def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxi trips from ``events``: one trip per event."""
    return trips_from_events(table(spark, sf_dir, "events"))


def trips_from_events(ev: DataFrame) -> DataFrame:
    """The trips projection of an events frame (batch or streaming)."""
    secs = F.lit(60) + F.pmod(F.col("event_id") * 37, F.lit(3600))
    return ev.select(
        F.col("event_id").alias("trip_id"),
        F.col("ts").alias("tpep_pickup_datetime"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs))
        .alias("tpep_dropoff_datetime"),
        (F.pmod(F.col("event_id") * 13, F.lit(200)).cast("double") / 10).alias("trip_distance"),
        (F.lit(10000) + F.pmod(F.col("user_id"), F.lit(20))).cast("int").alias("pickup_zip"),
        (F.lit(10000) + F.pmod(F.col("user_id") * 7 + F.col("event_id"), F.lit(20)))
        .cast("int").alias("dropoff_zip"),
        F.col("value").alias("fare_amount"),
    )


TRIPS_SQL = """
trips AS (
  SELECT event_id AS trip_id,
         ts AS tpep_pickup_datetime,
         ts + to_seconds(60 + (event_id * 37) % 3600) AS tpep_dropoff_datetime,
         CAST((event_id * 13) % 200 AS DOUBLE) / 10 AS trip_distance,
         CAST(10000 + user_id % 20 AS INTEGER) AS pickup_zip,
         CAST(10000 + (user_id * 7 + event_id) % 20 AS INTEGER) AS dropoff_zip,
         value AS fare_amount
  FROM events
)"""


# ------------------------------------------------------ regression table
WINE_FEATURES = ("l_quantity", "l_discount", "l_tax")
WINE_LABEL = "l_extendedprice"
WINE_ID = ("l_orderkey", "l_linenumber")


def regression_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wine-quality stand-in: label ``l_extendedprice``, three numeric features."""
    return table(spark, sf_dir, "lineitem").select(*WINE_ID, *WINE_FEATURES, WINE_LABEL)


# -------------------------------------------------------- dated measure
YEAR_EDGES = tuple(float(50_000 * i) for i in range(11))
# The temperature bin edges of the drift example.
TEMP_EDGES = (33.0, 40.0, 46.0, 52.0, 58.0, 64.0, 70.0, 76.0, 82.0, 88.0, 96.0)


def dated_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperature stand-in: ``(Date, year, temp)`` from ``orders``."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderdate").cast("date").alias("Date"),
        F.year("o_orderdate").alias("year"),
        F.col("o_totalprice").alias("temp"),
    )


# -------------------------------------------------------------- run log
# The metric names of the run log example.
RUN_METRICS = ("Mean absolute error", "Mean squared error")
STAGE_OF_STATUS = {"F": "Production", "O": "Staging", "P": "Archived"}


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log from ``orders``: one run per order."""
    o = table(spark, sf_dir, "orders")
    mae = F.col("o_totalprice") / F.lit(1000.0)
    return o.select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderpriority").alias("experiment"),
        F.concat(F.lit("run-"), F.col("o_orderstatus")).alias("run_name"),
        F.col("o_orderdate").alias("start_time"),
        F.create_map(F.lit("status"), F.col("o_orderstatus")).alias("params"),
        F.create_map(F.lit(RUN_METRICS[0]), mae, F.lit(RUN_METRICS[1]), mae * mae).alias("metrics"),
    )


def model_version_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model-version stage transitions from ``orders``.

    ``name`` = order priority, ``version`` = customer key as text, ``stage``
    from the order status, ``event_time`` = order date, ties broken by
    ``event_id`` (the order key).
    """
    o = table(spark, sf_dir, "orders")
    stages = F.create_map(*[F.lit(x) for kv in STAGE_OF_STATUS.items() for x in kv])
    stage = F.coalesce(stages[F.col("o_orderstatus")], F.lit("Archived"))
    return o.select(
        F.col("o_orderpriority").alias("name"),
        F.col("o_custkey").cast("string").alias("version"),
        stage.alias("stage"),
        F.col("o_orderdate").alias("event_time"),
        F.col("o_orderkey").alias("event_id"),
    )
