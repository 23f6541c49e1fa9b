"""Column functions over codes, times and parameter maps."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_source(code: Column) -> Column:
    return F.when(code.contains("RTRS"), F.lit("Reuters")).otherwise(code)


def last_segment(code: Column) -> Column:
    return F.split_part(code, F.lit(":"), F.lit(-1))


def is_excluded_source(code: Column, patterns: list[str]) -> Column:
    """The last segment matches one of the patterns, in any case; no code, no match."""
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | last_segment(code).rlike(f"(?iu){pattern}")
    return F.coalesce(hit, F.lit(False))


def to_utc(value: Column) -> Column:
    """UTC wall-clock time of a string or time; NULL where it does not parse."""
    return value.try_cast("timestamp").cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a UTC wall-clock time."""
    return F.unix_micros(ts.cast("timestamp"))


def hours_before(ts: Column, hours: int) -> Column:
    return ts - F.make_dt_interval(F.lit(0), F.lit(hours))


def plus_seconds(ts: Column, seconds: int) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))


def previous_day(as_of: Column) -> tuple[Column, Column]:
    """First and last second of the day before ``as_of``."""
    day = F.date_trunc("day", as_of).cast("timestamp_ntz")
    return hours_before(day, 24), plus_seconds(day, -1)


def day_before(as_of: Column) -> tuple[Column, Column]:
    """Midnight to midnight of the day before ``as_of``."""
    day = F.date_trunc("day", as_of).cast("timestamp_ntz")
    return hours_before(day, 24), day


def mask_params(params: Column, keys: list[str]) -> Column:
    """Parameter map with the values of secret keys starred out."""
    secret = "(?i)" + "|".join(re.escape(k) for k in keys)
    return F.transform_values(params, lambda k, v: F.when(k.rlike(secret), F.lit("*" * 8)).otherwise(v))


def response_ms(seconds: Column) -> Column:
    return F.round(seconds * 1000, 2)
