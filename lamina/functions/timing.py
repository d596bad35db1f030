"""Durations in hours as decimal(18,4), NULL while either end is open."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _hours(unit: str, start: str, end: str, per_hour: int) -> str:
    units = f"cast(timestampdiff({unit}, {start}, {end}) as decimal(20,0))"
    return f"cast({units} / {per_hour} as decimal(18,4))"


def hours_sql(start: str, end: str) -> str:
    """Exact hours, sub-second parts included."""
    return _hours("MICROSECOND", start, end, 3600000000)


def hours_between(start: str, end: str) -> Column:
    return F.expr(hours_sql(start, end))


def whole_second_hours(start: str, end: str) -> Column:
    """Hours counted in completed seconds."""
    return F.expr(_hours("SECOND", start, end, 3600))
