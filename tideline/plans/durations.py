"""Durations and instants as microseconds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType

_UNITS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
          "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}


def micros(text: str | int) -> int:
    """``"90 minutes"`` -> 5400000000. Integers pass through."""
    if isinstance(text, int):
        return text
    words = text.split()
    if len(words) % 2:
        raise ValueError(f"not a duration: {text!r}")
    return sum(int(n) * _UNITS[unit.rstrip("s").lower()] for n, unit in zip(words[::2], words[1::2]))


def at(column: str | Column) -> Column:
    """Instant as microseconds since the epoch, for zoned and zone-less timestamps."""
    return F.unix_micros((F.col(column) if isinstance(column, str) else column).cast("timestamp"))


def instant(us: Column, kind: str | DataType = "timestamp_ntz") -> Column:
    return F.timestamp_micros(us.cast("long")).cast(kind)


def floor_to(us: Column, width: int, offset: int = 0) -> Column:
    """Start of the ``width`` wide cell holding the instant, in exact integer arithmetic."""
    return us - F.pmod(us - F.lit(offset), F.lit(width))
