"""Session helpers: shared storage location and a local session for tests.

Anything we persist (feature tables, saved models, CSV round trips) goes under
the cluster's shared folder named by ``spark.checkpoint.dir``.  Only a session
with a ``local`` master may leave it unset (tests); it then gets a folder of
its own.  The caller's session is never changed.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
#: Folders of local sessions without a configured one, by application.
_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Root folder shared by driver and executors (``spark.checkpoint.dir``)."""
    root = spark.conf.get(_CONF, None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set {_CONF} to a folder that the driver and all executors share")
        app = spark.conf.get("spark.app.id", "local")
        if app not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="featflow-")
        root = _LOCAL_ROOTS[app]
    return root.rstrip("/")


def fresh_path(spark: SparkSession, *parts: str) -> str:
    """A new, unused path under the shared root (one per run, never reused)."""
    leaf = "-".join(p for p in parts if p) or "run"
    return f"{shared_root(spark)}/featflow/{leaf}-{uuid.uuid4().hex[:12]}"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "featflow") -> SparkSession:
    """Session for tests and the bench: AQE on, UI off, UTC, Arrow on."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FEATFLOW_DRIVER_MEM", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def stage(spark: SparkSession, df: DataFrame, label: str = "batch") -> DataFrame:
    """Materialise ``df`` once on shared storage and return a frame reading it.

    Cuts lineage: later readers read the staged files instead of re-running the
    plan, and a lost executor re-reads them instead of recomputing from the raw
    input.  The files stay for as long as lazy readers may need them; use
    :func:`staged` where they are only needed inside a block, or
    :func:`stage_scope` around the reading of a result.
    """
    path = fresh_path(spark, "stage", label)
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.format("parquet").save(path)
    return spark.read.schema(df.schema).format("parquet").load(path)


@contextmanager
def staged(spark: SparkSession, df: DataFrame, label: str = "batch") -> Iterator[DataFrame]:
    """:func:`stage` for the length of a block; the files go afterwards."""
    path = fresh_path(spark, "stage", label)
    df.write.format("parquet").save(path)
    try:
        yield spark.read.schema(df.schema).format("parquet").load(path)
    finally:
        delete_path(spark, path)


#: Paths staged inside the open scopes.
_SCOPES: list[list[str]] = []


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving whatever :func:`stage` wrote inside the block (so write
    or count a lazy result before leaving)."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whichever file system it is on."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop_path.getFileSystem(conf).delete(hadoop_path, True)


#: Bytes of (compressed, columnar) input files per partition that :func:`spread` makes.
SPREAD_BYTES = 4 << 20


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a plain scan of few files over the cluster's cores, in
    partitions whose size does not grow with the input.

    For CPU-heavy, row-local work.  Looks at the number and sizes of the input
    files only, so nothing is run to decide; a scan of many files is left as it is.
    """
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
    except (PySparkAttributeError, PySparkNotImplementedError):  # Spark Connect: keep the layout
        return df
    files = df.inputFiles()
    if len(files) >= cores:
        return df
    return df.repartition(max(cores, -(-_file_bytes(df.sparkSession, files) // SPREAD_BYTES)))


def _file_bytes(spark: SparkSession, files: list[str]) -> int:
    """Bytes of the files, on whichever file system they are."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        spark.sparkContext._jvm.java.net.URI(f)) for f in files]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Starting settings for a large run, to pass at submit time.

    Input splits and shuffle partitions are sized to ``partition_bytes`` so a
    task's data fits executor memory; the shuffle partition count is set for
    the largest shuffle (a sort-merge lookup moves the whole base) and AQE
    coalesces the small ones (window features shuffle only partial aggregates)
    and splits skewed ones.
    """
    cores = max(1, executors * cores_per_executor)
    shuffle = max(cores * 3, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        # Lookups in tables with one sorted file per bucket need no sort of the table.
        "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    }


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``featflow`` importable in Python workers (``addPyFile`` of a zip).

    Needed by operators whose closures run Python on executors (tree SHAP's
    ``mapInPandas``); the same as submitting with ``--py-files``.  Done once
    per Spark application.  The zip goes to the shared root when that is a
    local path; otherwise the driver serves it to executors.
    """
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # Spark Connect: no SparkContext on the client
        sc, app = None, f"connect-{id(spark)}"
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = shared_root(spark)
    folder = root[len("file:"):] if root.startswith("file:") else root
    if "://" in folder or not os.path.isdir(folder):
        folder = tempfile.mkdtemp(prefix="featflow-pyfiles-")
    target = os.path.join(folder, f"featflow-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg):
            if "__pycache__" in dirpath:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    if sc is not None:
        sc.addPyFile(target)
    else:
        spark.addArtifacts(target, pyfile=True)
    _SHIPPED.add(app)
