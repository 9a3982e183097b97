"""Feature lookups: training sets and batch scoring by key joins.

A :class:`FeatureLookup` names a feature table, the features to take and the
columns of the *base* frame that hold the table's primary key, in key order
(the names may differ: ``pickup_zip, rounded_pickup_datetime`` -> ``zip, ts``).
Each lookup is one left equi-join, so every base row survives and rows whose
key is missing or null get null features.

Join strategy is Spark's: the feature side is keyed unique, so the join never
multiplies rows; it is a broadcast hash join when the size of the (pruned)
feature side, estimated or measured at run time, is under the broadcast
threshold, and otherwise a sort-merge join whose skewed base partitions AQE
splits.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from featflow.functions.times import month_key
from featflow.sources.store import get_table


class LookupError_(ValueError):
    """Invalid lookup spec (name clash, key arity, missing column)."""


@dataclass(frozen=True)
class FeatureLookup:
    table_name: str
    feature_names: tuple[str, ...]
    lookup_key: tuple[str, ...]

    def __init__(self, table_name: str, feature_names: Sequence[str] | str,
                 lookup_key: Sequence[str] | str):
        object.__setattr__(self, "table_name", table_name)
        fn = (feature_names,) if isinstance(feature_names, str) else tuple(feature_names)
        lk = (lookup_key,) if isinstance(lookup_key, str) else tuple(lookup_key)
        object.__setattr__(self, "feature_names", fn)
        object.__setattr__(self, "lookup_key", lk)

    def to_dict(self) -> dict:
        return {"table_name": self.table_name, "feature_names": list(self.feature_names),
                "lookup_key": list(self.lookup_key)}

    @staticmethod
    def from_dict(d: dict) -> "FeatureLookup":
        return FeatureLookup(d["table_name"], d["feature_names"], d["lookup_key"])


def _month(key) -> Column:
    """``YYYY-MM`` (UTC) of an epoch-seconds column, whatever the session zone."""
    # Keys no 32-bit time can equal have no month, and no match.
    near = F.when(key.between(-(1 << 31), (1 << 31) - 1), key)
    wall = F.expr("TIMESTAMP_NTZ'1970-01-01'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), near)
    return F.when(wall.isNotNull(), month_key(wall, TimestampNTZType()))


def lookup_features(spark: SparkSession, base: DataFrame, lookup: FeatureLookup) -> DataFrame:
    """Left-join the named features of one feature table onto ``base``.

    Keys are compared in the wider of both types, so a key beyond the base
    column's range is a miss.  For a table with ``partition_time_key`` the month
    derived from the base's time key joins the partition column too, so Spark
    can prune months dynamically when the base is selective.  How the join runs
    (broadcast, sort-merge with skew splitting) is Spark's choice, from file
    sizes and, at run time, from measured sizes.
    """
    clash = [f for f in lookup.feature_names if f in base.columns]
    if clash:
        raise LookupError_(f"feature names already in the frame: {clash}")
    table = get_table(spark, lookup.table_name)
    keys = table.primary_keys
    if len(keys) != len(lookup.lookup_key):
        raise LookupError_(
            f"{lookup.table_name} has key {list(keys)}; lookup_key {list(lookup.lookup_key)} "
            "must name one base column per key column")
    missing = [c for c in lookup.lookup_key if c not in base.columns]
    if missing:
        raise LookupError_(f"lookup key columns not in the base frame: {missing}")
    unknown = [f for f in lookup.feature_names if f not in table.features]
    if unknown:
        raise LookupError_(f"{lookup.table_name} has no feature {unknown}")
    feats = spark.table(lookup.table_name)
    own = [f"_ff_key_{i}" for i in range(len(keys))]
    cols = [F.col(k).alias(o) for k, o in zip(keys, own)]
    month = table.partition_time_key is not None
    if month:
        cols.append(F.col(table.partition_columns[0]).alias("_ff_month"))
    side = feats.select(*cols, *lookup.feature_names)
    on = [base[b] == side[o] for b, o in zip(lookup.lookup_key, own)]
    if month:
        time_key = lookup.lookup_key[list(keys).index(table.partition_time_key)]
        on.append(_month(base[time_key]) == side["_ff_month"])
    return base.join(side, reduce(and_, on), "left").select(
        *[base[f"`{c}`"] for c in base.columns], *lookup.feature_names)


def apply_lookups(spark: SparkSession, base: DataFrame,
                  lookups: Sequence[FeatureLookup]) -> DataFrame:
    """Chain of left lookups; a feature name may appear only once overall."""
    seen: dict[str, str] = {}
    for lk in lookups:
        for f in lk.feature_names:
            if f in seen:
                raise LookupError_(f"feature {f!r} requested from {seen[f]} and {lk.table_name}")
            seen[f] = lk.table_name
    out = base
    for lk in lookups:
        out = lookup_features(spark, out, lk)
    return out


class TrainingSet:
    """Lazy training frame: base rows + looked-up features, minus exclusions."""

    def __init__(self, spark: SparkSession, df: DataFrame, feature_lookups: Sequence[FeatureLookup],
                 label: str | None, exclude_columns: Sequence[str] = ()):
        self.spark = spark
        self.df = df
        self.feature_lookups = tuple(feature_lookups)
        self.label = label
        self.exclude_columns = tuple(exclude_columns)
        if label is not None and label not in df.columns:
            raise LookupError_(f"label {label!r} not in the base frame")
        if label in self.exclude_columns:
            raise LookupError_("the label cannot be excluded")

    def load_df(self) -> DataFrame:
        joined = apply_lookups(self.spark, self.df, self.feature_lookups)
        return joined.drop(*self.exclude_columns)

    def feature_columns(self) -> list[str]:
        """Columns a model trains on: everything but the label."""
        return [c for c in self.load_df().columns if c != self.label]

    def spec_json(self) -> str:
        return json.dumps({
            "label": self.label,
            "exclude_columns": list(self.exclude_columns),
            "feature_lookups": [lk.to_dict() for lk in self.feature_lookups],
        })


def create_training_set(spark: SparkSession, df: DataFrame,
                        feature_lookups: Sequence[FeatureLookup], label: str | None,
                        exclude_columns: Sequence[str] = ()) -> TrainingSet:
    return TrainingSet(spark, df, feature_lookups, label, exclude_columns)
