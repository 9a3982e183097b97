"""Column-level helpers; every function returns a native Spark ``Column``."""

from featflow.functions.times import (  # noqa: F401
    as_instant,
    epoch_micros,
    epoch_seconds,
    filter_df_by_ts,
    is_weekend,
    month_key,
    parse_date,
    rounded_unix_timestamp,
    time_literal,
    utc_wallclock,
)
