"""Sliding and tumbling time-window features per key.

Two plans compute the same rows:

``method="direct"``
    ``groupBy(key, window(ts, length, slide))``.  Catalyst plans a sliding
    window as an ``Expand`` of every input row into ``length/slide`` copies
    before the partial aggregate.
``method="pane"``
    Aggregate raw rows once per (key, slide-sized pane) -- one partial
    aggregate, no row expansion -- then fan each *pane* out to the
    ``length/slide`` windows that contain it and re-aggregate the pane sums.
    Pays off when many rows share a (key, pane), i.e. dense keys at scale.

Both keep partial (map-side) aggregation, so a hot key never lands whole in
one task: each map task ships one partial row per (key, window) it saw.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featflow.functions.times import (
    dtype_of,
    epoch_seconds,
    filter_df_by_ts,
    is_weekend,
    month_key,
)

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def duration_seconds(text: str) -> int:
    """'1 hour' / '15 minutes' / '30 minute' -> seconds."""
    parts = text.strip().lower().split()
    if len(parts) != 2:
        raise ValueError(f"cannot read duration {text!r}")
    n, unit = int(parts[0]), parts[1].rstrip("s")
    if unit not in _UNITS:
        raise ValueError(f"unknown unit in {text!r}")
    return n * _UNITS[unit]


def window_mean_count(df: DataFrame, key: str, ts: str, value: str | None,
                      length: str, slide: str | None = None,
                      method: str = "direct") -> DataFrame:
    """Per (key, window): ``mean(value)``, ``count(*)`` and the window end.

    Returns columns ``key, window_end, mean_value, n_rows`` where ``mean_value``
    skips nulls (like ``avg``) and ``n_rows`` counts all rows, null values too.
    Rows with a null time leave no window (as with ``window()``).
    """
    slide = slide or length
    length_s, slide_s = duration_seconds(length), duration_seconds(slide)
    val = F.col(value) if value else F.lit(None).cast("double")
    if method == "direct":
        grouped = df.groupBy(F.col(key), F.window(ts, length, slide).alias("w"))
        return grouped.agg(
            F.avg(val).alias("mean_value"), F.count(F.lit(1)).alias("n_rows")
        ).select(F.col(key), F.col("w.end").alias("window_end"), "mean_value", "n_rows")
    if method != "pane":
        raise ValueError("method must be 'direct' or 'pane'")
    if length_s % slide_s:
        raise ValueError("pane method needs a window length that is a multiple of the slide")
    return windows_of_panes(panes(df, key, ts, value, slide), key, length, slide)


def panes(df: DataFrame, key: str, ts: str, value: str | None, slide: str) -> DataFrame:
    """Per (key, slide-sized pane) sums that add up: ``key, pane_end, s`` (sum of
    ``value``), ``nv`` (rows with a value), ``n`` (rows)."""
    val = F.col(value) if value else F.lit(None).cast("double")
    return (
        df.where(F.col(ts).isNotNull())
        .groupBy(F.col(key), F.window(ts, slide).end.alias("pane_end"))
        .agg(F.sum(val).alias("s"), F.count(val).alias("nv"), F.count(F.lit(1)).alias("n"))
    )


def window_ends(pane_end: Column, length: str, slide: str) -> Column:
    """Ends of the windows that contain a pane: a pane [p, p+slide) lies in the
    windows ending p+slide, ..., p+length."""
    slide_s = duration_seconds(slide)
    return F.array(*[F.timestamp_add("SECOND", F.lit(j * slide_s), pane_end)
                     for j in range(duration_seconds(length) // slide_s)])


def windows_of_panes(found: DataFrame, key: str, length: str, slide: str) -> DataFrame:
    """Windows from panes (several rows of a pane are added up); the columns of
    :func:`window_mean_count`."""
    ends = F.explode(window_ends(F.col("pane_end"), length, slide))
    return (
        found.select(F.col(key), ends.alias("window_end"), "s", "nv", "n")
        .groupBy(key, "window_end")
        .agg((F.sum("s") / F.nullif(F.sum("nv"), F.lit(0))).alias("mean_value"),
             F.sum("n").alias("n_rows"))
    )


def window_count(df: DataFrame, key: str, ts: str, length: str) -> DataFrame:
    """Per (key, tumbling window): ``count(*)`` and the window end."""
    return (
        df.groupBy(F.col(key), F.window(ts, length).alias("w"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.col(key), F.col("w.end").alias("window_end"), "n_rows")
    )


def _keyed(end: Column, end_type) -> list[Column]:
    return [
        epoch_seconds(end, end_type).cast("int").alias("ts"),
        month_key(end, end_type).alias("yyyy_mm"),
    ]


def pickup_features_fn(df: DataFrame, ts_column: str | None = None, start_date=None,
                       end_date=None, *, method: str = "pane",
                       time_col: str = "tpep_pickup_datetime", key_col: str = "pickup_zip",
                       value_col: str = "fare_amount") -> DataFrame:
    """Pickup feature group: per zip, 1-hour windows sliding every 15 minutes.

    Columns: ``zip, ts`` (INT epoch seconds of the window end), ``yyyy_mm``,
    ``mean_fare_window_1h_pickup_zip`` (FLOAT), ``count_trips_window_1h_pickup_zip``
    (INT).  The range filter runs before windowing, so windows at the range
    edges are partial.
    """
    df = filter_df_by_ts(df, ts_column, start_date, end_date)
    end_type = dtype_of(df, time_col)
    agg = window_mean_count(df, key_col, time_col, value_col, "1 hour", "15 minutes", method)
    return pickup_columns(agg, key_col, end_type)


def pickup_columns(agg: DataFrame, key_col: str, end_type) -> DataFrame:
    """Names and types of the pickup feature group."""
    return agg.select(
        F.col(key_col).alias("zip"),
        *_keyed(F.col("window_end"), end_type),
        F.col("mean_value").cast("float").alias("mean_fare_window_1h_pickup_zip"),
        F.col("n_rows").cast("int").alias("count_trips_window_1h_pickup_zip"),
    )


def dropoff_features_fn(df: DataFrame, ts_column: str | None = None, start_date=None,
                        end_date=None, *, time_col: str = "tpep_dropoff_datetime",
                        key_col: str = "dropoff_zip") -> DataFrame:
    """Dropoff feature group: per zip, tumbling 30-minute windows.

    Columns: ``zip, ts, yyyy_mm, count_trips_window_30m_dropoff_zip`` (INT) and
    ``dropoff_is_weekend`` (INT) -- the weekend flag of the window *end* in New
    York, so the window ending Saturday 00:00 counts as weekend.
    """
    df = filter_df_by_ts(df, ts_column, start_date, end_date)
    end_type = dtype_of(df, time_col)
    agg = window_count(df, key_col, time_col, "30 minutes")
    return agg.select(
        F.col(key_col).alias("zip"),
        *_keyed(F.col("window_end"), end_type),
        F.col("n_rows").cast("int").alias("count_trips_window_30m_dropoff_zip"),
        is_weekend(F.col("window_end"), end_type).alias("dropoff_is_weekend"),
    )


def apply_feature_fn(df: DataFrame, fn, ts_column: str | None = None, start_date=None,
                     end_date=None, **kwargs) -> DataFrame:
    """Run a user feature function ``fn(df, ts_column, start_date, end_date)``.

    The plug-in unit of the feature pipeline: any callable with that
    signature (returning a DataFrame) can feed :mod:`featflow.sources.store`.
    """
    out = fn(df, ts_column=ts_column, start_date=start_date, end_date=end_date, **kwargs)
    if not isinstance(out, DataFrame):
        raise TypeError("a feature function must return a DataFrame")
    return out
