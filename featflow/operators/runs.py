"""Run log and model-version log as append-only tables, queried with Spark.

Tracking is an append: one row per run (params and metrics as maps) and one
row per model-version stage transition.  Every read is an aggregation over
those rows -- "latest run", "current stage", "latest version" are
``max_by`` per key, which aggregates partially on the map side, so a key
holding a third of the log never gathers in one task.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = ("run_id string, experiment string, run_name string, start_time timestamp_ntz, "
              "params map<string,string>, metrics map<string,double>")
VERSION_SCHEMA = ("name string, version string, stage string, event_time timestamp_ntz, "
                  "event_id bigint")
# The registry stages.
STAGES = ("None", "Staging", "Production", "Archived")


def _snake(text: str) -> str:
    return re.sub(r"[^0-9a-zA-Z]+", "_", text).strip("_").lower()


def log_run(spark: SparkSession, path: str, experiment: str, metrics: Mapping[str, float],
            params: Mapping[str, str] | None = None, run_name: str | None = None,
            run_id: str | None = None, start_time: _dt.datetime | None = None) -> str:
    """Append one run to the run log at ``path`` (many at once: :func:`log_runs`)."""
    return log_runs(spark, path, [dict(experiment=experiment, metrics=metrics, params=params,
                                       run_name=run_name, run_id=run_id,
                                       start_time=start_time)])[0]


def log_runs(spark: SparkSession, path: str, runs: Sequence[Mapping]) -> list[str]:
    """Append runs in one file; each is a mapping with ``experiment`` and
    ``metrics`` and the optional arguments of :func:`log_run`.  Returns the ids."""
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = [(r.get("run_id") or uuid.uuid4().hex, r["experiment"], r.get("run_name"),
             r.get("start_time") or now,
             {k: str(v) for k, v in (r.get("params") or {}).items()},
             {k: float(v) for k, v in r["metrics"].items()}) for r in runs]
    spark.createDataFrame(rows, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return [r[0] for r in rows]


def compact_log(spark: SparkSession, path: str, target: str, files: int = 1) -> str:
    """Rewrite a log of many small files as ``files`` files at ``target``."""
    spark.read.parquet(path).repartition(files).write.parquet(target)
    return target


def log_stage(spark: SparkSession, path: str, name: str, version: str | int, stage: str,
              event_time: _dt.datetime | None = None, event_id: int | None = None,
              model_path: str | None = None) -> None:
    """Append a stage transition of a model version; ``model_path`` is where the
    version's files are."""
    if stage not in STAGES:
        raise ValueError(f"stage must be one of {STAGES}")
    event_time = event_time or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    event_id = event_id if event_id is not None else uuid.uuid4().int >> 65
    spark.createDataFrame([(name, str(version), stage, event_time, event_id, model_path)],
                          VERSION_SCHEMA + ", model_path string").write.mode("append").parquet(path)


def search_runs(runs: DataFrame, experiment: str | None = None,
                metric_names: Sequence[str] | None = None) -> DataFrame:
    """Runs (of one experiment) with metrics flattened to ``metrics_<name>`` columns.

    Metric names are given or read from the log (a distinct over map keys --
    bounded by the number of metric names, not runs).
    """
    if experiment is not None:
        runs = runs.where(F.col("experiment") == F.lit(experiment))
    if metric_names is None:
        metric_names = sorted(r[0] for r in runs.select(F.explode(F.map_keys("metrics")))
                              .distinct().collect())
    names: dict[str, int] = {}
    columns = []
    for m in metric_names:
        name = f"metrics_{_snake(m)}"
        names[name] = names.get(name, 0) + 1
        if names[name] > 1:  # metrics that only differ in punctuation or case
            name = f"{name}_{names[name]}"
        columns.append(F.col("metrics")[m].alias(name))
    return runs.select("run_id", "experiment", "run_name", "start_time", *columns)


def latest_runs(runs: DataFrame, by: str = "experiment") -> DataFrame:
    """Most recent run per ``by`` value (start time, then run id, descending)."""
    order = F.struct("start_time", "run_id")
    latest = runs.groupBy(by).agg(F.max_by(F.struct(*[c for c in runs.columns if c != by]),
                                           order).alias("r"))
    return latest.select(by, "r.*")


def latest_run(runs: DataFrame, experiment: str) -> DataFrame:
    """The single most recent run of an experiment (top-1, no global sort)."""
    return latest_runs(runs.where(F.col("experiment") == F.lit(experiment)))


def runs_by_start(runs: DataFrame) -> DataFrame:
    """Runs ordered by start time descending (ties: run id descending)."""
    return runs.orderBy(F.desc("start_time"), F.desc("run_id"))


def compare_runs(runs: DataFrame, metric: str, pivot_col: str = "run_name",
                 values: Sequence[str] | None = None) -> DataFrame:
    """Per experiment, the best (lowest) value of ``metric`` for each ``pivot_col`` value."""
    m = F.col("metrics")[metric]
    g = runs.groupBy("experiment")
    pv = g.pivot(pivot_col, list(values)) if values is not None else g.pivot(pivot_col)
    return pv.agg(F.min(m))


def latest_model_version(versions: DataFrame) -> DataFrame:
    """Per model name: the highest numeric version, at least 1."""
    v = F.max(F.expr("try_cast(version AS INT)"))
    return versions.groupBy("name").agg(
        F.coalesce(F.greatest(v, F.lit(1)), F.lit(1)).alias("latest_version"))


def current_stages(versions: DataFrame) -> DataFrame:
    """Current stage of every (name, version): its latest transition."""
    return versions.groupBy("name", "version").agg(
        F.max_by("stage", F.struct("event_time", "event_id")).alias("stage"))


def resolve_stage(versions: DataFrame, stage: str) -> DataFrame:
    """``models:/<name>/<stage>``: per name, the highest version now in ``stage``."""
    cur = current_stages(versions).where(F.col("stage") == F.lit(stage))
    return cur.groupBy("name").agg(
        F.max_by("version", F.expr("try_cast(version AS INT)")).alias("version"))


def model_path(versions: DataFrame, name: str, version: str | int | None = None,
               stage: str | None = None) -> str:
    """Path of a model's version, of its highest version in a stage, or (neither
    given) of its latest version; pass it on to ``score_batch``."""
    own = versions.where(F.col("name") == F.lit(name))
    if version is None:
        if stage is not None:
            found = resolve_stage(own, stage).first()
        else:
            found = own.agg(F.max_by("version", F.expr("try_cast(version AS INT)"))
                            .alias("version")).first()
        version = found["version"] if found else None
    path = own.where(F.col("version") == F.lit(str(version))).agg(
        F.max_by("model_path", F.struct("event_time", "event_id")).alias("p")).first()["p"]
    if path is None:
        raise LookupError(f"no files known for model {name!r}, version {version}, stage {stage}")
    return path
