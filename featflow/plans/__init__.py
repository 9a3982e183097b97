"""The named query set: Spark callables and their DuckDB twins."""
