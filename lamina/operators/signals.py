"""Several event sources brought to one shape."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from lamina.operators.dimensions import project
from lamina.operators.keys import ROW, tag_rows


@dataclass(frozen=True)
class Rule:
    """How one raw table becomes events: which rows, and each column as a SQL expression."""

    table: str
    columns: Mapping[str, str]
    where: str | None = None


def unify(rules: Sequence[Rule], raw: Callable[[str], DataFrame]) -> DataFrame:
    """Union of all rules by column name, rows tagged for keying.

    The predicate comes before the tag, so it still reaches the scan of the raw table.
    Foreign keys are resolved on the union, once for all sources.
    """
    return reduce(DataFrame.unionByName, [_apply(rule, raw(rule.table)) for rule in rules])


def _apply(rule: Rule, source: DataFrame) -> DataFrame:
    kept = source if rule.where is None else source.where(rule.where)
    return project(tag_rows(kept), {**rule.columns, ROW: ROW})
