"""Weighted scores in exact decimals and their level bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SCORE_TYPE = "decimal(18,4)"


def score(weights: Mapping[str, str], divisors: Mapping[str, str] | None = None) -> Column:
    """Sum of ``metric * weight`` and ``metric / divisor``, unrounded.

    Weights and divisors are decimal text, so no binary fraction enters the sum.
    Dividends are widened first to keep 17 places of each quotient.
    """
    terms = [f"{metric} * {weight}" for metric, weight in weights.items()]
    terms += [
        f"cast({metric} as decimal(28,10)) / {divisor}"
        for metric, divisor in (divisors or {}).items()
    ]
    return F.expr(" + ".join(terms))


def band(value: Column, floors: Sequence[tuple[str, str]], otherwise: str) -> Column:
    """Level of the first floor the value reaches; floors run from the highest down."""
    level = F.lit(otherwise)
    for floor, name in reversed(floors):
        level = F.when(value >= F.expr(floor), name).otherwise(level)
    return level
