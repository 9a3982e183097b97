"""featflow: the data side of tabular ML, written as Spark DataFrame plans.

Subpackages
-----------
functions  column-level helpers (time grids, weekend flags, array maths)
sources    readers, writers and keyed feature tables on the session catalog
operators  window features, lookup joins, models, tree SHAP, drift, run log
plans      the named query set (``queries()`` / ``oracle_sql()``) and the
           stand-in inputs derived from the test tables
streaming  incremental refresh of window features with Structured Streaming
"""

__version__ = "0.1.0"
