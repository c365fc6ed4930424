"""Timestamps kept as integers in a stated unit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Microseconds in one of each unit.
MICROS_IN = {
    "MICROSECONDS": 1,
    "MILLISECONDS": 1_000,
    "SECONDS": 1_000_000,
    "MINUTES": 60_000_000,
    "HOURS": 3_600_000_000,
}


def to_time(c: Column, precision: str = "MILLISECONDS") -> Column:
    """Timestamp of an integer in the given unit; null beyond its range.

    Nanoseconds are cut to microseconds, the finest that Spark keeps.
    """
    value = c.try_cast("bigint")
    unit = precision.upper()
    if unit == "NANOSECONDS":
        below = F.pmod(value, F.lit(1000).cast("bigint"))
        return F.timestamp_micros(F.call_function("div", F.try_subtract(value, below), F.lit(1000)))
    if unit not in MICROS_IN:
        raise ValueError(f"unknown precision: {precision}")
    return F.timestamp_micros(F.try_multiply(value, F.lit(MICROS_IN[unit]).cast("bigint")))


def as_timestamp(c: str | Column) -> Column:
    """Zoned timestamp; files without a zone are read as the session's."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp")


def micros(c: Column) -> Column:
    return F.unix_micros(as_timestamp(c))
