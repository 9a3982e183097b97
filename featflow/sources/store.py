"""Keyed, partitioned feature tables on the session catalog.

A feature table is an external Parquet table with:

* a composite primary key (checked on every write: no null, no duplicate),
* partition columns (``yyyy_mm`` in the taxi example),
* a description (the table comment) and free-form tags,

all kept in the catalog itself (``COMMENT`` / ``TBLPROPERTIES``), so any Spark
user can read the table with plain SQL.

``write_table(mode="merge")`` is an upsert by primary key without a
transactional table format: only the partitions the incoming rows touch are
rewritten.  Old rows of those partitions whose key is not in the batch are
kept (anti join), incoming rows win on a key match.  Columns absent from the
batch keep their stored value for existing keys (null for new keys).

There is one write path.  New files always go to a fresh version folder of the
table; what was written is listed from the file system (so partition values
are named as Spark renders them, whatever their type); then each catalog
partition (or the unpartitioned table) is pointed at its new files, and it is
checked that every written partition is registered.  A partition is thus always
complete, old or new, even if the driver dies half way.  Replaced files stay
for readers that still scan them until :func:`vacuum` removes them.  An empty
string as partition value is stored as null, as Spark's file layout does.

A table that is looked up far more often than it is written can be clustered by
its key (``bucket_count``): one sorted file per bucket of key hashes.  A
sort-merge lookup then moves and sorts the base only, never the table.  Such a
table has no partitions, and a merge rewrites it as a whole.
When the session catalog can run ``MERGE INTO`` (a Delta table) a user can do
that instead; we do not depend on it.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from featflow.session import delete_path, fresh_path, shared_root, staged

_P = "featflow."
_KEYS = _P + "primary_keys"
_PARTS = _P + "partition_columns"
_PART_OF_KEY = _P + "partition_of_key"
_TIME_KEY = _P + "partition_time_key"
_BUCKETS = _P + "bucket_count"
_BASE = _P + "base_path"
_TAG = _P + "tag."
_VERSIONS = "_versions"
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class FeatureTableError(ValueError):
    """Raised on key violations and invalid feature-table requests."""


@dataclass(frozen=True)
class FeatureTable:
    name: str
    primary_keys: tuple[str, ...]
    partition_columns: tuple[str, ...]
    features: tuple[str, ...]
    description: str
    path: str
    partition_of_key: bool = True
    tags: dict = field(default_factory=dict)
    partition_time_key: str | None = None
    bucket_count: int = 0


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS``, placed under the shared root by default."""
    loc = location or f"{shared_root(spark)}/featflow/databases/{database}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION {_lit(loc)}")


def check_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail if any key is null or any key occurs twice (one aggregation job)."""
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise FeatureTableError(f"primary key columns missing: {missing}")
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    bad = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where((F.col("_n") > 1) | any_null)
        .limit(1)
        .collect()
    )
    if bad:
        row = bad[0].asDict()
        kind = "null" if any(row[k] is None for k in keys) else "duplicate"
        raise FeatureTableError(f"{kind} primary key {dict((k, row[k]) for k in keys)}")


def create_table(spark: SparkSession, name: str, primary_keys: Sequence[str],
                 df: DataFrame | None = None, schema: StructType | None = None,
                 partition_columns: Sequence[str] | str | None = None,
                 description: str = "", path: str | None = None,
                 partition_of_key: bool = True,
                 partition_time_key: str | None = None,
                 bucket_count: int = 0, validate: bool = True) -> FeatureTable:
    """Register a feature table; if ``df`` is given also write its rows.

    ``partition_of_key`` states that the partition columns are a function of
    the primary key (``yyyy_mm`` of ``ts``); merges then only read and rewrite
    the partitions of the incoming rows.  Otherwise a merge first finds the
    partitions holding the incoming keys.  ``partition_time_key`` names an INT
    epoch-seconds key column whose UTC month (``YYYY-MM``) is the partition
    value; lookups can then prune partitions to the base's key range.
    ``bucket_count`` clusters a table without partitions by its key: choose it so
    that a bucket's file is some 100 to 500 MB and lookups have enough tasks.
    Reading a bucket's order needs ``spark.sql.legacy.bucketedTableScan.outputOrdering``
    (:func:`featflow.session.cluster_conf` has it); without it lookups still move
    nothing of the table, but sort it.
    ``validate=False`` skips the key check (a shuffle of the whole table) for
    rows that are unique by construction, e.g. a ``groupBy`` over the key.
    """
    if df is None and schema is None:
        raise FeatureTableError("pass df or schema")
    if isinstance(partition_columns, str):
        partition_columns = [partition_columns]
    parts = tuple(partition_columns or ())
    keys = tuple(primary_keys)
    schema = schema or df.schema
    names = [f.name for f in schema.fields]
    for c in keys + parts:
        if c not in names:
            raise FeatureTableError(f"column {c!r} not in schema")
    if "." in name:
        ensure_database(spark, name.split(".")[0])
    location = path or fresh_path(spark, "table", name.replace(".", "_"))
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    props = {
        _KEYS: ",".join(keys),
        _PARTS: ",".join(parts),
        _PART_OF_KEY: str(bool(partition_of_key)).lower(),
        _BASE: location,
    }
    if partition_time_key:
        if partition_time_key not in keys or len(parts) != 1:
            raise FeatureTableError("partition_time_key must be a key column of a table "
                                    "with one partition column")
        props[_TIME_KEY] = partition_time_key
    cluster_sql = ""
    if bucket_count:
        if parts:
            raise FeatureTableError("a table has buckets or partition columns, not both")
        props[_BUCKETS] = str(int(bucket_count))
        by = ", ".join(f"`{k}`" for k in keys)
        cluster_sql = f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {int(bucket_count)} BUCKETS"
    prop_sql = ", ".join(f"{_lit(k)}={_lit(v)}" for k, v in props.items())
    part_sql = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
    spark.sql(
        f"CREATE TABLE {_q(name)} ({cols}) USING parquet {part_sql} {cluster_sql} "
        f"LOCATION {_lit(location)} COMMENT {_lit(description)} TBLPROPERTIES ({prop_sql})"
    )
    if df is not None:
        try:
            _replace(spark, name, df.select(*names), parts, location, set(),
                     keys if validate else (), (bucket_count, keys))
        except FeatureTableError:
            drop_table(spark, name)
            delete_path(spark, location)
            raise
    return get_table(spark, name)


def get_table(spark: SparkSession, name: str) -> FeatureTable:
    """Keys, partitioning, description, tags, location and feature names."""
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_q(name)}").collect()}
    if _KEYS not in props:
        raise FeatureTableError(f"{name} is not a feature table")
    meta = spark.catalog.getTable(name)
    detail = {
        r["col_name"]: r["data_type"]
        for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_q(name)}").collect()
    }
    keys = tuple(k for k in props[_KEYS].split(",") if k)
    parts = tuple(p for p in props.get(_PARTS, "").split(",") if p)
    cols = spark.table(name).columns
    return FeatureTable(
        name=name,
        primary_keys=keys,
        partition_columns=parts,
        features=tuple(c for c in cols if c not in keys and c not in parts),
        description=meta.description or "",
        path=props.get(_BASE) or detail.get("Location", ""),
        partition_of_key=props.get(_PART_OF_KEY, "true") == "true",
        tags={k[len(_TAG):]: v for k, v in props.items() if k.startswith(_TAG)},
        partition_time_key=props.get(_TIME_KEY),
        bucket_count=int(props.get(_BUCKETS, 0)),
    )


def table_info(spark: SparkSession, name: str) -> DataFrame:
    """:func:`get_table` as a one-row DataFrame (for SQL users and reports)."""
    t = get_table(spark, name)
    schema = (
        "name string, primary_keys array<string>, partition_columns array<string>, "
        "features array<string>, description string, tags map<string,string>"
    )
    row = (t.name, list(t.primary_keys), list(t.partition_columns), list(t.features),
           t.description, dict(t.tags))
    return spark.createDataFrame([row], schema)


def set_feature_table_tag(spark: SparkSession, table_name: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {_q(table_name)} SET TBLPROPERTIES ({_lit(_TAG + key)}={_lit(str(value))})")


def delete_feature_table_tag(spark: SparkSession, table_name: str, key: str) -> None:
    spark.sql(f"ALTER TABLE {_q(table_name)} UNSET TBLPROPERTIES IF EXISTS ({_lit(_TAG + key)})")


def _named(parts: Sequence[str]):
    """Partition values as the text Spark names folders with (null stays null)."""
    return [F.nullif(F.col(p).cast("string"), F.lit("")).alias(p) for p in parts]


def _partition_filter(parts: Sequence[str], values: list[tuple]):
    """Rows of the listed partitions (values as folder text); prunes partitions."""
    cond = F.lit(False)
    for v in values:
        one = F.lit(True)
        for p, x in zip(parts, v):
            text = F.col(p).cast("string")
            one = one & (text.isNull() if x is None else (text == F.lit(x)))
        cond = cond | one
    return cond


def write_table(spark: SparkSession, name: str, df: DataFrame, mode: str = "merge",
                validate: bool = True) -> None:
    """Write rows into a feature table: ``merge`` (upsert by key), ``overwrite`` or
    ``partitions`` (the rows replace all rows of the partitions they fall in; no
    other partition is read or changed).

    ``validate=False`` skips the null/duplicate key check of the batch.
    """
    t = get_table(spark, name)
    table_cols = spark.table(name).columns
    extra = [c for c in df.columns if c not in table_cols]
    if extra:
        raise FeatureTableError(f"columns not in {name}: {extra}")
    keys, parts = list(t.primary_keys), list(t.partition_columns)
    missing = [c for c in table_cols if c not in df.columns]
    if mode in ("overwrite", "partitions"):
        if missing:
            raise FeatureTableError(f"{mode} needs every column; missing {missing}")
        if mode == "partitions" and not parts:
            raise FeatureTableError(f"{name} has no partition columns")
        _replace(spark, name, df.select(*table_cols), parts, t.path,
                 None if mode == "overwrite" else set(), keys if validate else (),
                 (t.bucket_count, keys))
        return
    if mode != "merge":
        raise FeatureTableError("mode must be 'merge', 'overwrite' or 'partitions'")
    with staged(spark, df, name.replace(".", "_")) as batch:
        if validate:
            check_keys(batch, keys)
        _merge(spark, t, batch, table_cols, missing)


def _merge(spark: SparkSession, t: FeatureTable, batch: DataFrame, table_cols: list[str],
           missing: list[str]) -> None:
    existing = spark.table(t.name)
    keys, parts = list(t.primary_keys), list(t.partition_columns)
    replaced: set[str] = set()
    if parts:
        # Distinct partition values of the batch: bounded by the table's
        # partition count (months), never by its row count.
        touched = batch.select(*_named(parts))
        if not t.partition_of_key:
            touched = touched.unionByName(
                existing.join(batch.select(*keys), keys, "left_semi").select(*_named(parts)))
        values = [tuple(r) for r in touched.distinct().collect()]
        if not values:
            return
        existing = existing.where(_partition_filter(parts, values))
        replaced = {_folder(spark, parts, v) for v in values}
    incoming = batch
    if missing:
        # Columns not supplied keep their stored value for existing keys.
        incoming = batch.join(existing.select(*keys, *missing), keys, "left")
    incoming = incoming.select(*table_cols)
    keep = existing.select(*table_cols).join(incoming.select(*keys), keys, "left_anti")
    _replace(spark, t.name, keep.select(*table_cols).unionByName(incoming), parts, t.path,
             replaced, (), (t.bucket_count, keys))


def _folder(spark: SparkSession, parts: Sequence[str], values: Sequence[str | None]) -> str:
    """Relative folder of a partition, escaped as Spark does."""
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(f"{names.escapePathName(p)}="
                    f"{_NULL_FOLDER if v is None else names.escapePathName(v)}"
                    for p, v in zip(parts, values))


def _spec(spark: SparkSession, folder: str) -> str:
    """``PARTITION`` clause of a relative folder."""
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    out = []
    for part in folder.split("/"):
        k, _, v = part.partition("=")
        value = "null" if v == _NULL_FOLDER else _lit(names.unescapePathName(v))
        out.append(f"`{names.unescapePathName(k)}`={value}")
    return f"PARTITION ({', '.join(out)})"


def _list(spark: SparkSession, path: str, depth: int) -> list[tuple[str, int]]:
    """(path relative to ``path``, modification time in ms) of folders ``depth`` down."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [("", root, 0)]
    for _ in range(depth):
        found = [(f"{rel}/{x.getPath().getName()}".lstrip("/"), x.getPath(),
                  x.getModificationTime())
                 for rel, p, _ in found if fs.exists(p)
                 for x in fs.listStatus(p)
                 if x.isDirectory() and not x.getPath().getName().startswith("_temporary")]
    return [(rel, at) for rel, _, at in found]


def _partitions(spark: SparkSession, name: str) -> set[str]:
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {_q(name)}").collect()}


def _write_buckets(spark: SparkSession, scratch: str, frame: DataFrame, path: str, count: int,
                   keys: Sequence[str]) -> None:
    """One file per bucket, sorted by key.  Spark writes buckets to catalog tables
    only; ``scratch`` names an external one, which leaves its files when dropped."""
    # Hashed as buckets are, so every task holds just one bucket.
    frame.repartition(count, *keys).write.format("parquet").bucketBy(count, *keys) \
        .sortBy(*keys).option("path", path).saveAsTable(scratch)
    drop_table(spark, scratch)


def _replace(spark: SparkSession, name: str, frame: DataFrame, parts: Sequence[str], base: str,
             replaced: set[str] | None, check: Sequence[str],
             buckets: tuple[int, Sequence[str]]) -> None:
    """Write ``frame`` to a new version folder and switch the table to it.

    ``replaced`` names the partitions whose present rows are superseded by
    ``frame`` (None: all); those it has no rows for are dropped.  ``check``:
    key columns to validate on the written files before the switch.  ``buckets``:
    their number (0: none) and the columns they are made and sorted by.
    """
    root = f"{base}/{_VERSIONS}/{uuid.uuid4().hex}"
    if buckets[0]:
        _write_buckets(spark, f"{name}_{uuid.uuid4().hex[:12]}", frame, root, *buckets)
    else:
        writer = frame.write.format("parquet")
        if parts:
            writer = writer.partitionBy(*parts)
        writer.save(root)
    if check:
        check_keys(spark.read.schema(frame.schema).parquet(root), check)
    if not parts:
        spark.sql(f"ALTER TABLE {_q(name)} SET LOCATION {_lit(root)}")
    else:
        written = {rel for rel, _ in _list(spark, root, len(parts))}
        current = _partitions(spark, name)
        for rel in sorted(written & current):
            spark.sql(f"ALTER TABLE {_q(name)} {_spec(spark, rel)} "
                      f"SET LOCATION {_lit(f'{root}/{rel}')}")
        if written - current:
            new = " ".join(f"{_spec(spark, rel)} LOCATION {_lit(f'{root}/{rel}')}"
                           for rel in sorted(written - current))
            spark.sql(f"ALTER TABLE {_q(name)} ADD {new}")
        lost = written - _partitions(spark, name)
        if lost:
            raise FeatureTableError(f"written partitions not registered in {name}: {sorted(lost)}")
        gone = (current if replaced is None else replaced & current) - written
        if gone:
            spark.sql(f"ALTER TABLE {_q(name)} DROP "
                      + ", ".join(_spec(spark, rel) for rel in sorted(gone)))
    spark.sql(f"REFRESH TABLE {_q(name)}")
    # File sizes only, no scan, so that the planner can size joins.
    spark.sql(f"ANALYZE TABLE {_q(name)} COMPUTE STATISTICS NOSCAN")


def vacuum(spark: SparkSession, name: str, retention_s: float = 7 * 86400) -> int:
    """Delete replaced files older than the retention time; returns the number
    of folders removed.  Files the catalog refers to are never touched."""
    t = get_table(spark, name)
    state = spark._jsparkSession.sessionState()
    ident = state.sqlParser().parseTableIdentifier(_q(name))
    depth = len(t.partition_columns) + 1
    used = set()
    if t.partition_columns:
        found = state.catalog().listPartitions(ident, spark._jvm.scala.Option.empty()).iterator()
        while found.hasNext():
            used.add(found.next().storage().locationUri().get().getPath())
    else:
        used.add(state.catalog().getTableMetadata(ident).location().getPath())
    removed = 0
    before = (time.time() - retention_s) * 1000
    for rel, at in _list(spark, f"{t.path}/{_VERSIONS}", depth):
        path = f"{t.path}/{_VERSIONS}/{rel}"
        plain = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()
        if plain not in used and at <= before:
            delete_path(spark, path)
            removed += 1
    return removed


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_q(name)}")
