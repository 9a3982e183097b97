"""Readers and writers: stored tables by path or name, delimited text, views.

Thin on purpose -- these are Spark's own readers with the reference's options
spelled out, plus the one thing a cluster needs: an explicit schema as the
normal route for text (inference scans the data twice and can drift between
files), with inference still available.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan a stored table by path (columns pruned and filters pushed by Catalyst)."""
    return spark.read.format(fmt).load(path)


def read_named(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table by name."""
    return spark.read.table(name)


def read_delimited(spark: SparkSession, path: str, sep: str = ",", header: bool = True,
                   schema: StructType | str | None = None, infer: bool = False) -> DataFrame:
    """Delimited text.  Pass ``schema`` (preferred) or ``infer=True``."""
    reader = spark.read.format("csv").option("header", header).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.load(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    df.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """``createOrReplaceTempView``; returns the frame for chaining."""
    df.createOrReplaceTempView(name)
    return df


def sample_range(df: DataFrame, ts_column: str, start=None, end=None,
                 fraction: float = 1.0, seed: int = 42,
                 key_cols: Sequence[str] | None = None) -> DataFrame:
    """Date-range restriction then a seeded sample (input preparation).

    With ``key_cols`` a row is taken by the hash of its key, the same rows
    wherever and however often this runs; otherwise by ``DataFrame.sample``,
    which depends on the partitioning.
    """
    from featflow.functions.times import filter_df_by_ts
    from featflow.operators.models import hash_fraction

    out = filter_df_by_ts(df, ts_column, start, end)
    if fraction >= 1.0:
        return out
    if key_cols:
        return out.where(hash_fraction(key_cols, seed) < fraction)
    return out.sample(fraction=fraction, seed=seed)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows as a DataFrame (the notebook ``display``)."""
    return df.limit(n)
