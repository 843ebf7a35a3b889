"""Epoch nanoseconds to timestamps, calendar parts and time grain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NANOS_PER_SECOND = 1_000_000_000

# Output column names of the date dimension.
CALENDAR_PARTS = {
    "year": F.year,
    "month": F.month,
    "week": F.weekofyear,
    "day_of_month": F.dayofmonth,
    "day_of_week": F.dayofweek,
    "quarter": F.quarter,
}

GRAINS = ("second", "day")


def epoch_seconds(nanos: str) -> Column:
    """Epoch nanoseconds as fractional seconds (double)."""
    return F.col(nanos) / F.lit(NANOS_PER_SECOND)


def epoch_timestamp(nanos: str) -> Column:
    """Epoch nanoseconds as a timestamp of whole seconds, fraction dropped toward zero.

    Integer division keeps every value exact. Going through ``epoch_seconds``
    would round a value less than a microsecond short of a second up to it, and
    going through local-time text would move the repeated hour of a daylight
    saving change.
    """
    return F.timestamp_seconds(F.call_function("div", F.col(nanos), F.lit(NANOS_PER_SECOND)))


def calendar_parts(timestamp: str) -> list[Column]:
    """Year, month, ISO week, day of month, day of week (Sunday is 1) and quarter."""
    return [part(timestamp).alias(name) for name, part in CALENDAR_PARTS.items()]


def at_grain(timestamp: Column, grain: str) -> Column:
    """The timestamp itself at "second" grain, or the start of its day."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}; known: {', '.join(GRAINS)}")
    return timestamp if grain == "second" else F.date_trunc("day", timestamp)
