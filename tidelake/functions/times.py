"""Times of trips: elapsed time, hour keys and load stamps.

Datetimes are text without a zone. They are read as TIMESTAMP_NTZ so that no result depends on
the session time zone; text that cannot be read gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def local_time(value: Column | str) -> Column:
    return _column(value).try_cast("timestamp_ntz")


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    return F.unix_timestamp(local_time(end)) - F.unix_timestamp(local_time(start))


def elapsed_minutes(start: Column | str, end: Column | str) -> Column:
    return elapsed_seconds(start, end) / F.lit(60.0)


def hour_key(value: Column | str) -> Column:
    """yyyyMMddHH as a bigint, the key of the hour dimension."""
    t = local_time(value)
    return (
        F.year(t).cast("bigint") * 1_000_000
        + F.month(t) * 10_000
        + F.dayofmonth(t) * 100
        + F.hour(t)
    )


def year_of(value: Column | str) -> Column:
    return F.lpad(F.year(local_time(value)).cast("string"), 4, "0")


def month_of(value: Column | str) -> Column:
    return F.lpad(F.month(local_time(value)).cast("string"), 2, "0")


def load_ts(epoch_seconds: int | None = None) -> Column:
    """One epoch second for all rows of a load; pass it in to make a rerun repeatable."""
    if epoch_seconds is None:
        return F.unix_timestamp()
    return F.lit(epoch_seconds).cast("bigint")
