"""Registry of every named query: ``QUERIES`` (Spark) and ``ORACLE_SQL`` (DuckDB).

All queries but those that fit Spark ML models have a DuckDB twin; the
``tree_shap_*`` queries of such models check themselves row by row (see
:mod:`featflow.plans.learning`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from featflow.plans import files, learning, monitoring, streams, taxi, tracking, trees

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}

for _mod in (taxi, monitoring, tracking, learning, trees, files, streams):
    QUERIES.update(_mod.QUERIES)
    ORACLE_SQL.update(_mod.SQL)

# A twin must belong to a query.
for _name in list(ORACLE_SQL):
    if _name not in QUERIES:
        raise RuntimeError(f"oracle without a query: {_name}")
