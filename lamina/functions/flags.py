"""Two-valued flags out of Y/N text and counters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def yes_sql(flag: str) -> str:
    """True for exactly ``'Y'``; everything else, NULL included, is false."""
    return f"coalesce({flag} = 'Y', false)"


def is_yes(flag: str) -> Column:
    return F.expr(yes_sql(flag))


def positive_sql(measure: str) -> str:
    """True where the measure exceeds zero; NULL is false."""
    return f"coalesce({measure} > 0, false)"


def is_positive(measure: str) -> Column:
    return F.expr(positive_sql(measure))
