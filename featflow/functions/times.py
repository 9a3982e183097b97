"""Time helpers as native column expressions (no Python UDFs).

Time columns may be ``TIMESTAMP_NTZ`` (wall clock, read as UTC) or
``TIMESTAMP`` (an instant).  The functions that depend on the kind take the
column's data type; :func:`dtype_of` reads it off a DataFrame.  Everything is
whole-number arithmetic on epoch microseconds, so results do not depend on the
session time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

_US_PER_SEC = 1_000_000
_US_PER_HOUR = 3_600 * _US_PER_SEC
_NTZ_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# Fixed value: the zone the weekend flag is evaluated in.
NEW_YORK = "America/New_York"


def dtype_of(df: DataFrame, name: str) -> DataType:
    """Data type of a (possibly nested, dotted) column of ``df``."""
    return df.select(F.col(name)).schema.fields[0].dataType


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(c: str | Column, dtype: DataType) -> Column:
    """Microseconds since 1970-01-01 UTC; NTZ values are read as UTC."""
    c = _col(c)
    if isinstance(dtype, TimestampNTZType):
        # Built from calendar fields: ``timestampdiff`` would cast NTZ to the
        # session zone and be an hour off in a DST gap.
        day_us = F.unix_date(F.to_date(c)).cast("long") * F.lit(86_400 * _US_PER_SEC)
        hm_us = (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * F.lit(_US_PER_SEC)
        sec_us = (F.extract(F.lit("SECOND"), c) * _US_PER_SEC).cast("long")
        return day_us + hm_us + sec_us
    if isinstance(dtype, TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, DateType):
        return F.unix_date(c).cast("long") * F.lit(86_400 * _US_PER_SEC)
    raise TypeError(f"expected a timestamp or date column, got {dtype.simpleString()}")


def utc_wallclock(c: str | Column, dtype: DataType) -> Column:
    """The UTC wall clock of a time column as ``TIMESTAMP_NTZ`` (exact)."""
    c = _col(c)
    if isinstance(dtype, TimestampNTZType):
        return c
    if isinstance(dtype, TimestampType):
        return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.expr(_NTZ_EPOCH))
    if isinstance(dtype, DateType):
        return c.cast("timestamp_ntz")
    raise TypeError(f"expected a timestamp or date column, got {dtype.simpleString()}")


def as_instant(c: str | Column, dtype: DataType) -> Column:
    """The column as a ``TIMESTAMP`` instant (NTZ read as UTC); exact, zone-free."""
    if isinstance(dtype, TimestampType):
        return _col(c)
    return F.timestamp_micros(epoch_micros(c, dtype))


def epoch_seconds(c: str | Column, dtype: DataType) -> Column:
    """``unix_timestamp``: whole seconds since the epoch (floor), as BIGINT."""
    us = epoch_micros(c, dtype)
    return F.floor(us / F.lit(_US_PER_SEC)).cast("long")


def rounded_unix_timestamp(c: str | Column, dtype: DataType, num_minutes: int = 15) -> Column:
    """Ceil a time to the ``num_minutes`` grid that restarts every hour; INT epoch seconds.

    Semantics of the original scalar function: take the seconds elapsed since
    the top of the hour, round them *up* to a multiple of the step, add that to
    the top of the hour.  A time already on the grid stays put; one microsecond
    past moves to the next grid point; a step that does not divide 60 can
    overshoot into the next hour (10:55 with 25 minutes gives 11:15).

    Note the look-ahead this implies: a trip is keyed to the window that ends
    up to ``num_minutes`` *after* it, so a lookup on this key sees a window
    that contains the trip itself.  Null in, null out.
    """
    if num_minutes <= 0:
        raise ValueError("num_minutes must be positive")
    us = epoch_micros(c, dtype)
    step = num_minutes * 60 * _US_PER_SEC
    into_hour = F.pmod(us, F.lit(_US_PER_HOUR))
    hour_start = us - into_hour
    # into_hour < 3.6e9 and step >= 6e7: the quotient is exact in a double.
    k = F.ceil(into_hour / F.lit(step))
    return ((hour_start + k * F.lit(step)) / F.lit(_US_PER_SEC)).cast("int")


def is_weekend(c: str | Column, dtype: DataType, tz: str = NEW_YORK) -> Column:
    """1 when the instant falls on a Saturday or Sunday in ``tz``, else 0 (INT)."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wallclock(c, dtype))
    return (F.weekday(local) >= 5).cast("int")


def month_key(c: str | Column, dtype: DataType) -> Column:
    """``"YYYY-MM"`` of the UTC wall clock (the feature tables' partition key)."""
    wall = utc_wallclock(c, dtype)
    return F.format_string("%04d-%02d", F.year(wall), F.month(wall))


def parse_date(c: str | Column, fmt: str = "d/M/yyyy") -> Column:
    """Text to DATE with a pattern; unparseable text gives null instead of an error."""
    return F.try_to_date(_col(c), fmt)


def time_literal(value, dtype: DataType) -> Column:
    """A literal of the same time kind as the column it is compared with.

    Bounds are instants: one with a UTC offset (an aware ``datetime`` or text
    ending in an offset) is that instant, one without is UTC wall-clock time,
    whatever the zone of the session or the driver.  NTZ columns hold UTC
    wall-clock time.  A literal of the column's own type lets the filter reach
    the Parquet scan.
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        try:
            value = _dt.datetime.fromisoformat(value)
        except ValueError:
            pass
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        text = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        text = f"{value.isoformat()} 00:00:00"
    else:
        text = str(value)
    if isinstance(dtype, TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    if isinstance(dtype, TimestampType):
        return F.lit(f"{text}+00:00").cast("timestamp")
    if isinstance(dtype, DateType):
        return F.lit(text).cast("date")
    return F.lit(value)


def filter_df_by_ts(df: DataFrame, ts_column: str | None, start_date=None,
                    end_date=None) -> DataFrame:
    """Half-open range ``start_date <= ts < end_date``; each bound optional.

    Without a column name, or with a falsy bound, that side is left open.
    """
    if not ts_column:
        return df
    dtype = dtype_of(df, ts_column)
    if start_date:
        df = df.filter(F.col(ts_column) >= time_literal(start_date, dtype))
    if end_date:
        df = df.filter(F.col(ts_column) < time_literal(end_date, dtype))
    return df
