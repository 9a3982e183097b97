"""Window features kept up to date from stored partial sums.

A feature table holds finished means and counts.  Two ranges of input that touch
in the middle of a window both give a row for it, and merging keeps the later,
partial one.  Panes do add up: the state table holds, per (key, pane, batch), the
sum and counts of a batch's rows, and a window is the sum over its panes and over
all batches.

* A batch writes only its own partitions (month of the pane's end, batch), so
  adding one never reads or rewrites the others, and a batch added again after a
  failure replaces its own rows: nothing counts twice.  A batch name stands for
  one fixed part of the input (a range, a file list).
* :func:`refresh` computes anew just the windows that a batch has panes in.  It
  reads the state's months around the batch and merges the rows into the feature
  table by key.
* :func:`compact` folds all batches into a new state table, to be used instead of
  the old one, when there are many.

Rows of a batch move once, as one partial sum per task and pane; a hot key costs one
row per task and pane.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featflow.functions.times import dtype_of, month_key
from featflow.operators.windows import duration_seconds, panes, window_ends, windows_of_panes
from featflow.sources import store

_KEYS = ("key", "pane_end", "batch")


def _spans(length: str, slide: str) -> None:
    if duration_seconds(length) % duration_seconds(slide):
        raise ValueError("the window length must be a multiple of the slide")


def batch_panes(df: DataFrame, key: str, ts: str, value: str | None, slide: str,
                batch: str) -> DataFrame:
    """Rows of the state table for one batch of input.

    Rows with a null time give none; a null key is a group of its own; null
    values count as rows, not as values.  ``value`` may be None (counts only).
    """
    found = panes(df, key, ts, value, slide)
    end_type = dtype_of(found, "pane_end")
    return found.select(
        F.col(key).alias("key"), "pane_end", F.col("s").cast("double").alias("s"), "nv", "n",
        month_key(F.col("pane_end"), end_type).alias("yyyy_mm"), F.lit(batch).alias("batch"))


def create_state(spark: SparkSession, name: str, like: DataFrame,
                 description: str = "") -> store.FeatureTable:
    """An empty state table for rows as :func:`batch_panes` gives them."""
    return store.create_table(spark, name, _KEYS, schema=like.schema,
                              partition_columns=["yyyy_mm", "batch"], description=description)


def add_batch(spark: SparkSession, name: str, rows: DataFrame) -> None:
    """Add one batch's panes; the same batch again replaces them."""
    # Unique by construction: one row per key and pane.
    store.write_table(spark, name, rows, mode="partitions", validate=False)


def windows(state: DataFrame, length: str, slide: str) -> DataFrame:
    """All windows of a state: ``key, window_end, mean_value, n_rows``."""
    _spans(length, slide)
    return windows_of_panes(state, "key", length, slide)


def touched_windows(state: DataFrame, batch: str, length: str, slide: str) -> DataFrame:
    """The windows that ``batch`` has panes in, with the rows of all batches.

    The batch's time range is looked up first (one row), so only panes within a
    window length of it are read, and only their months.
    """
    _spans(length, slide)
    own = state.where(F.col("batch") == batch)
    first, last = own.agg(F.min("pane_end"), F.max("pane_end")).first()
    if first is None:
        return windows_of_panes(own, "key", length, slide)
    end_type = dtype_of(state, "pane_end")
    span = F.make_dt_interval(secs=F.lit(duration_seconds(length)))
    low, high = F.lit(first).cast(end_type) - span, F.lit(last).cast(end_type) + span
    near = state.where(F.col("pane_end").between(low, high)
                       & F.col("yyyy_mm").between(month_key(low, end_type),
                                                  month_key(high, end_type)))
    ends = F.explode(window_ends(F.col("pane_end"), length, slide)).alias("end")
    mine = own.select(F.col("key").alias("own_key"), ends).distinct()
    found = windows_of_panes(near, "key", length, slide)
    return found.join(mine, found["key"].eqNullSafe(mine["own_key"])
                      & (found["window_end"] == mine["end"]), "left_semi")


def refresh(spark: SparkSession, state: str, table: str, batch: str, length: str, slide: str,
            columns) -> None:
    """Bring a feature table up to date with ``batch``: its windows are computed
    from all batches and merged by key.  ``columns(windows, key_column, end_type)``
    names the features (e.g. :func:`featflow.operators.windows.pickup_columns`).
    Feature tables have no null keys, so windows of a null key stay in the state.
    """
    rows = spark.table(state)
    found = touched_windows(rows, batch, length, slide).where(F.col("key").isNotNull())
    store.write_table(spark, table, columns(found, "key", dtype_of(found, "window_end")),
                      mode="merge", validate=False)


def compact(spark: SparkSession, name: str, target: str, batch: str = "all") -> store.FeatureTable:
    """A new state table ``target`` with the batches of ``name`` added up into one.

    Its rows are all there before it has a name, and ``name`` is left as it is,
    so a crash loses nothing.
    """
    state = spark.table(name)
    rows = state.groupBy("key", "pane_end", "yyyy_mm").agg(
        F.sum("s").alias("s"), F.sum("nv").alias("nv"), F.sum("n").alias("n"))
    return store.create_table(spark, target, _KEYS,
                              df=rows.withColumn("batch", F.lit(batch)).select(*state.columns),
                              partition_columns=["yyyy_mm", "batch"], validate=False)
