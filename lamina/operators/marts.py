"""Report shapes over snapshots, signals and dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions.flags import positive_sql


def with_flags(df: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """Add ``{flag: measure}`` columns that say whether the measure is above zero."""
    return df.selectExpr(
        "*", *[f"{positive_sql(measure)} as {flag}" for flag, measure in flags.items()]
    )


def trend(df: DataFrame, entity: str, time: str, value: str, previous: str, delta: str) -> DataFrame:
    """Value of the entity's previous row and the change since; NULL on its first row.

    ``df`` holds one row per entity and ``time``, so a window group is as long as the list of
    report dates, however many entities there are.
    """
    line = Window.partitionBy(entity).orderBy(F.col(time).asc_nulls_last())
    with_previous = df.withColumn(previous, F.lag(value).over(line))
    return with_previous.withColumn(delta, F.col(value) - F.col(previous))


def restrict(signals: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose column is one of the listed values."""
    return signals.where(F.col(column).isin(*values))
