"""Timestamp <-> microsecond arithmetic that does not depend on the session zone (DST gaps included).

Series timestamps are kept as ``timestamp_ntz`` (wall clock, like naive pandas
datetimes). An LTZ input is first converted to NTZ in the session zone.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
DAY_US = 86_400_000_000

_UNITS = {
    "us": 1, "microsecond": 1, "microseconds": 1,
    "ms": 1_000, "millisecond": 1_000, "milliseconds": 1_000,
    "s": 1_000_000, "sec": 1_000_000, "second": 1_000_000, "seconds": 1_000_000,
    "min": 60_000_000, "t": 60_000_000, "minute": 60_000_000, "minutes": 60_000_000,
    "h": 3_600_000_000, "hour": 3_600_000_000, "hours": 3_600_000_000,
    "d": DAY_US, "day": DAY_US, "days": DAY_US,
}


def freq_micros(freq: str | int) -> int:
    """'1 minute', '1min', '7min', '1h', '1 day', 60000000 -> microseconds."""
    if isinstance(freq, int):
        return freq
    m = re.fullmatch(r"\s*(\d*)\s*([A-Za-z]+)\s*", freq)
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"unsupported fixed frequency: {freq!r}")
    k = int(m.group(1) or 1)
    if k <= 0:
        raise ValueError(f"frequency must be positive: {freq!r}")
    return k * _UNITS[m.group(2).lower()]


def as_ntz(df: DataFrame, col: str) -> Column:
    """The column as timestamp_ntz (LTZ is converted in the session zone)."""
    dt = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dt, T.TimestampNTZType):
        return c
    if isinstance(dt, (T.TimestampType, T.DateType)):
        return c.cast(T.TimestampNTZType())
    raise TypeError(f"{col} must be a timestamp, got {dt.simpleString()}")


def _epoch() -> Column:
    return F.expr(EPOCH_NTZ)


def to_micros(c: Column) -> Column:
    """timestamp_ntz -> microseconds since 1970-01-01 (wall clock), from the calendar
    fields alone, so no session zone (and no DST gap) is ever involved."""
    days = F.unix_date(F.to_date(c)).cast("long")
    secs = F.date_part(F.lit("SECOND"), c)  # seconds with the fraction, decimal(8,6)
    return (days * F.lit(DAY_US) + F.hour(c).cast("long") * F.lit(3_600_000_000)
            + F.minute(c).cast("long") * F.lit(60_000_000) + (secs * F.lit(1_000_000)).cast("long"))


def from_micros(c: Column) -> Column:
    """microseconds since 1970-01-01 -> timestamp_ntz."""
    return F.timestamp_add("MICROSECOND", c, _epoch())
