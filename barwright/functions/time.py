"""Time helpers that never depend on the session time zone (bar times are wall clocks,
``timestamp_ntz``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "1970-01-01 00:00:00"


def micros_between(start: Column, end: Column) -> Column:
    """Microseconds from ``start`` to ``end`` (wall clocks; no time-zone shifts)."""
    return F.timestamp_diff("MICROSECOND", start, end)


def seconds_between(end: Column, start: Column) -> Column:
    """Duration in seconds with the fraction."""
    return micros_between(start, end) / F.lit(1e6)


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later``, floored (timedelta.days semantics, F4)."""
    return F.floor(micros_between(earlier, later) / F.lit(86_400_000_000)).cast("long")


def wall_to_instant(ts: Column) -> Column:
    """A wall clock read as UTC -> TIMESTAMP (for event-time operators that need one)."""
    return F.timestamp_micros(micros_between(F.lit(_EPOCH).cast("timestamp_ntz"), ts))


def instant_to_wall(ts: Column) -> Column:
    """Inverse of ``wall_to_instant``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.lit(_EPOCH).cast("timestamp_ntz"))
