"""Run-log and model-registry queries over logs derived from ``orders``."""

from __future__ import annotations

import datetime as dt

from featflow.operators.runs import (
    RUN_SCHEMA,
    compare_runs,
    latest_model_version,
    latest_runs,
    log_run,
    resolve_stage,
    runs_by_start,
    search_runs,
)
from featflow.plans.fixtures import RUN_METRICS, model_version_log, run_log
from featflow.session import fresh_path

EXPERIMENT = "1-URGENT"
RUN_NAMES = ("run-F", "run-O", "run-P")


def q_runs_search(spark, sf_dir):
    """Runs of one experiment, newest first (start time, then run id)."""
    return runs_by_start(search_runs(run_log(spark, sf_dir), EXPERIMENT, RUN_METRICS))


def q_runs_latest(spark, sf_dir):
    r = latest_runs(run_log(spark, sf_dir))
    return r.select(
        "experiment", "run_id", "start_time",
        r["metrics"][RUN_METRICS[0]].alias("metrics_mean_absolute_error"),
        r["metrics"][RUN_METRICS[1]].alias("metrics_mean_squared_error"),
    )


def q_runs_compare(spark, sf_dir):
    out = compare_runs(run_log(spark, sf_dir), RUN_METRICS[0], "run_name", RUN_NAMES)
    return out.toDF("experiment", *[n.replace("-", "_") for n in RUN_NAMES])


def q_model_latest_version(spark, sf_dir):
    return latest_model_version(model_version_log(spark, sf_dir))


def q_model_current_stage(spark, sf_dir):
    return resolve_stage(model_version_log(spark, sf_dir), "Staging")


def q_runs_append(spark, sf_dir):
    """Latest run per experiment after two runs were appended to the stored log."""
    path = fresh_path(spark, "run-log")
    run_log(spark, sf_dir).write.parquet(path)
    late = dt.datetime(2030, 1, 1)
    log_run(spark, path, EXPERIMENT, {RUN_METRICS[0]: 1.5}, run_name="late", run_id="late-1",
            start_time=late)
    log_run(spark, path, "own", {RUN_METRICS[0]: 2.5}, run_name="first", run_id="own-1",
            start_time=late)
    r = latest_runs(spark.read.schema(RUN_SCHEMA).parquet(path))
    return r.select("experiment", "run_id", "run_name", "start_time",
                    r["metrics"][RUN_METRICS[0]].alias("mae"))


QUERIES = {
    "runs_append": q_runs_append,
    "runs_search": q_runs_search,
    "runs_latest": q_runs_latest,
    "runs_compare": q_runs_compare,
    "model_latest_version": q_model_latest_version,
    "model_current_stage": q_model_current_stage,
}

_RUNS = """
runs AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS experiment,
         'run-' || o_orderstatus AS run_name, o_orderdate AS start_time,
         o_totalprice / 1000.0 AS mae, (o_totalprice / 1000.0) * (o_totalprice / 1000.0) AS mse
  FROM orders
)"""

_VERSIONS = """
versions AS (
  SELECT o_orderpriority AS name, CAST(o_custkey AS VARCHAR) AS version,
         CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Staging'
              ELSE 'Archived' END AS stage,
         o_orderdate AS event_time, o_orderkey AS event_id
  FROM orders
)"""

SQL = {
    "runs_append": f"""WITH {_RUNS},
        a AS (SELECT experiment, run_id, run_name, start_time, mae FROM runs
              UNION ALL SELECT '{EXPERIMENT}', 'late-1', 'late', TIMESTAMP '2030-01-01', 1.5
              UNION ALL SELECT 'own', 'own-1', 'first', TIMESTAMP '2030-01-01', 2.5)
        SELECT experiment, run_id, run_name, start_time, mae FROM a
        QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id DESC) = 1""",
    "runs_search": f"""WITH {_RUNS}
        SELECT run_id, experiment, run_name, start_time,
               mae AS metrics_mean_absolute_error, mse AS metrics_mean_squared_error
        FROM runs WHERE experiment = '{EXPERIMENT}'""",
    "runs_latest": f"""WITH {_RUNS},
        ranked AS (SELECT *, row_number() OVER (PARTITION BY experiment
                   ORDER BY start_time DESC, run_id DESC) AS rn FROM runs)
        SELECT experiment, run_id, start_time, mae AS metrics_mean_absolute_error,
               mse AS metrics_mean_squared_error FROM ranked WHERE rn = 1""",
    "runs_compare": f"""WITH {_RUNS}
        SELECT experiment,
               min(mae) FILTER (WHERE run_name = 'run-F') AS run_F,
               min(mae) FILTER (WHERE run_name = 'run-O') AS run_O,
               min(mae) FILTER (WHERE run_name = 'run-P') AS run_P
        FROM runs GROUP BY experiment""",
    "model_latest_version": f"""WITH {_VERSIONS}
        SELECT name, coalesce(greatest(max(TRY_CAST(version AS INTEGER)), 1), 1)
               AS latest_version
        FROM versions GROUP BY name""",
    "model_current_stage": f"""WITH {_VERSIONS},
        cur AS (SELECT name, version, stage, row_number() OVER (PARTITION BY name, version
                ORDER BY event_time DESC, event_id DESC) AS rn FROM versions),
        staged AS (SELECT name, version, row_number() OVER (PARTITION BY name
                   ORDER BY TRY_CAST(version AS INTEGER) DESC) AS rk
                   FROM cur WHERE rn = 1 AND stage = 'Staging')
        SELECT name, version FROM staged WHERE rk = 1""",
}
