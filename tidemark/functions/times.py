"""Time expressions. No function reads a clock: callers pass as_of."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(as_of: str | datetime | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def boundaries(unit: str, start: Column, end: Column) -> Column:
    """How many boundaries of a unit (second, minute, hour, day) lie between; 00:00:59 to 00:01:00 has
    one minute boundary. Null if either side is."""
    if unit == "day":
        return F.datediff(end, start).cast("long")
    width = {"second": 1, "minute": 60, "hour": 3600}[unit]
    at = lambda c: F.unix_timestamp(F.date_trunc(unit, c))
    return ((at(end) - at(start)) / width).cast("long")


def to_millis(c: Column) -> Column:
    """Truncated, never rounded, to milliseconds: a marker must not pass what was read."""
    return F.date_trunc("millisecond", c)


def iso_ticks(c: Column) -> Column:
    """UTC with seven fractional digits; Spark has six, so the last is 0."""
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("0Z"))


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def in_zone(c: Column, zone: str) -> Column:
    """A UTC instant as the wall clock of a zone, for display only."""
    return F.from_utc_timestamp(c, zone)
