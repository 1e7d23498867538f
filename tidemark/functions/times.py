"""Timestamp arithmetic in whole microseconds, the same for zoned and zone-less timestamps."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECOND = 1_000_000
HOUR = 3_600 * SECOND
DAY = 24 * HOUR

# Width suffixes and their length in microseconds.
WIDTH_UNITS = {
    "s": SECOND,
    "min": 60 * SECOND,
    "t": 60 * SECOND,
    "h": HOUR,
    "d": DAY,
}


def width_micros(width: str) -> int:
    """``'1h'``, ``'1H'``, ``'30min'``, ``'7d'`` ... as microseconds."""
    match = re.fullmatch(r"\s*(\d*)\s*([A-Za-z]+)\s*", width)
    unit = WIDTH_UNITS.get(match.group(2).lower()) if match else None
    if unit is None:
        raise ValueError(f"unsupported bin width: {width!r}")
    micros = int(match.group(1) or 1) * unit
    if micros <= 0:
        raise ValueError(f"bin width must be positive: {width!r}")
    return micros


def is_zoneless(df: DataFrame, column: str) -> bool:
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return True
    if isinstance(kind, T.TimestampType):
        return False
    raise TypeError(f"{column} must be a timestamp, found {kind.simpleString()}")


def to_micros(column: Column, zoneless: bool) -> Column:
    if zoneless:
        epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
        return F.timestamp_diff("MICROSECOND", epoch, column)
    return F.unix_micros(column)


def from_micros(column: Column, zoneless: bool) -> Column:
    if zoneless:
        epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
        return F.timestamp_add("MICROSECOND", column, epoch)
    return F.timestamp_micros(column)


def duration_hours(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(float(HOUR))


def month_key(column: Column) -> Column:
    """``YYYY-MM``; null stays null (such rows belong to no month)."""
    return F.date_format(column, "yyyy-MM")


def common_step(a: int, b: int) -> int:
    return math.gcd(a, b)
