"""Per-entity measures: wide metrics, long factors, and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def activity(table: DataFrame, entity: str, measures: Mapping[str, str]) -> DataFrame:
    """One row per entity with ``{measure: SQL aggregate}`` over its rows, all in one pass.

    Rows without an entity form a group of their own, which joins on the entity never meet.
    """
    return table.groupBy(entity).agg(
        *[F.expr(f"{expression} as {name}") for name, expression in measures.items()]
    )


def with_measures(
    base: DataFrame, entity: str, activities: Sequence[tuple[DataFrame, Sequence[str]]]
) -> DataFrame:
    """Every row of ``base`` with the named measures of each activity, zero where it has none.

    Each activity is one row per entity, so all joins hash on the entity alone.
    """
    kept = base.columns
    names = [name for _, measures in activities for name in measures]
    for found, measures in activities:
        known = found.where(f"{entity} is not null").select(entity, *measures)
        base = base.join(known, entity, "left")
    return base.selectExpr(*kept, *[f"coalesce({name}, 0) as {name}" for name in names])


def entity_metrics(
    base: DataFrame, entity: str, tables: Sequence[tuple[DataFrame, Mapping[str, str]]]
) -> DataFrame:
    """Every row of ``base`` with the aggregates of each event table, zero where it has none.

    ``tables`` pairs a table with ``{metric: SQL aggregate}``. Each table is aggregated
    before it meets the base, and all of them hash on the entity alone.
    """
    known = f"{entity} is not null"
    return with_measures(
        base, entity, [(activity(t.where(known), entity, metrics), list(metrics)) for t, metrics in tables]
    )


@dataclass(frozen=True)
class Factor:
    """A counter over events: its code and label, its domain, and which events count."""

    code: str
    name: str
    domain: str
    where: str


def factor_measures(factors: Sequence[Factor]) -> dict[str, str]:
    """``{factor code: SQL aggregate}`` for ``activity``."""
    return {f.code: f"count_if({f.where})" for f in factors}


def factors_long(events: DataFrame, entity: str, factors: Sequence[Factor]) -> DataFrame:
    """One row per entity and factor with at least one event, out of a single pass.

    Events without an entity form a group of their own.
    """
    return factor_lines(activity(events, entity, factor_measures(factors)), entity, factors)


def factor_lines(counts: DataFrame, entity: str, factors: Sequence[Factor]) -> DataFrame:
    """The same from one row per entity that holds the count of each factor under its code."""
    lines = ", ".join(
        f"named_struct('risk_factor_code', '{f.code}', 'risk_factor_name', '{f.name}', "
        f"'factor_value_num', cast({f.code} as decimal(18,4)), 'risk_domain', '{f.domain}')"
        for f in factors
    )
    return counts.selectExpr(entity, f"inline(array({lines}))").where("factor_value_num > 0")


def factors_wide(long: DataFrame, entity: str, columns: Mapping[str, str]) -> DataFrame:
    """Factor rows as one row per entity: ``{factor code: column}``, whole numbers, zero if absent."""
    return (
        long.groupBy(entity)
        .pivot("risk_factor_code", list(columns))
        .agg(F.sum("factor_value_num"))
        .selectExpr(
            entity,
            *[f"cast(coalesce({c}, 0) as bigint) as {name}" for c, name in columns.items()],
        )
    )
