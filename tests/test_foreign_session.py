"""Queries must not depend on how the caller configured its session."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

NAMES = ["trips_rounded", "pickup_features", "dropoff_features", "training_set",
         "feature_merge", "drift_report", "runs_latest", "tree_shap_fixed", "csv_dates"]

CODE = """
import sys
sys.path.insert(0, {root!r}); sys.path.insert(0, {tests!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]")
         .config("spark.sql.session.timeZone", "America/Los_Angeles")
         .config("spark.sql.adaptive.enabled", "false")
         .config("spark.sql.shuffle.partitions", "200").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
import __spark_entry__ as E
from oracle_harness import compare, duck
con = duck("/root/testdata/sf0.001")
for n in {names!r}:
    r = compare(spark, con, n, E.queries()[n], E.oracle_sql()[n], "/root/testdata/sf0.001")
    print("STATUS", n, r["status"], flush=True)
"""


def test_queries_in_a_differently_configured_session(tmp_path):
    code = CODE.format(root=ROOT, tests=os.path.join(ROOT, "tests"), names=NAMES)
    # The child finds libraries where the parent does, however the parent got there.
    env = dict(os.environ, PYTHONPATH=os.pathsep.join(p for p in sys.path if p and p != ROOT))
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=1200)
    statuses = dict(line.split()[1:3] for line in out.stdout.splitlines()
                    if line.startswith("STATUS"))
    assert len(statuses) == len(NAMES), out.stderr[-2000:]
    assert all(s in ("exact", "close") for s in statuses.values()), statuses
