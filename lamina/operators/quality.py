"""Checks between layers. Each gives a DataFrame; ``require`` turns one into a gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Violating lines that an error quotes.
SHOWN = 20


class CheckFailed(ValueError):
    """A data check found violations."""


def row_parity(
    source: Mapping[str, DataFrame | int], target: Mapping[str, DataFrame]
) -> DataFrame:
    """Row counts of each table on both sides and whether they agree.

    All tables are counted in one aggregation: each task hands on one partial count per table.
    A source may also be a count taken while its rows were read for something else.
    """
    if source.keys() != target.keys():
        raise ValueError(f"tables differ: {sorted(source.keys() ^ target.keys())}")
    spark = next(iter(target.values())).sparkSession
    # One line per table without a side, so that empty tables show up with zero.
    counted = [n if isinstance(n, int) else 0 for n in source.values()]
    names = pa.table(
        {
            "table_name": list(source),
            "side": pa.nulls(len(source), pa.string()),
            "known": pa.array(counted, pa.int64()),
        }
    )
    parts = [spark.createDataFrame(names)]
    for side, tables in (("src", source), ("dst", target)):
        for table, df in tables.items():
            if not isinstance(df, int):
                parts.append(
                    df.selectExpr(f"'{table}' as table_name", f"'{side}' as side", "0L as known")
                )
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("table_name")
        .agg(F.expr("count_if(side = 'src') + sum(known) as src_cnt"), F.expr("count_if(side = 'dst') as dst_cnt"))
        .selectExpr("*", "src_cnt = dst_cnt as ok")
    )


def contents(columns: Sequence[str]) -> dict[str, Column]:
    """Aggregates that are equal for equal rows in any order: a count, a sum and a parity of hashes.

    The sum and the parity are of two independent hashes of the whole row, with a NULL mark for
    every column; both are combined on the map side, so a table costs one line per task.
    """
    marked = ", ".join(f"`{c}`, `{c}` is null" for c in columns)
    return {
        "cnt": F.count("*"),
        "total": F.expr(f"coalesce(sum(cast(xxhash64({marked}) as decimal(20,0))), 0)").cast("decimal(38,0)"),
        "parity": F.expr(f"coalesce(bit_xor(xxhash64('x', {marked})), 0)"),
    }


def content_parity(
    source: Mapping[str, DataFrame], target: Mapping[str, DataFrame], ranges: Mapping[str, str]
) -> DataFrame:
    """Whether both sides hold the same rows, per table and range of rows.

    ``ranges`` gives, for each table, the SQL expression that says which range a row is in, such as
    the month of a date or the head of a key; other columns on one side than on the other are an
    error. A range that one side lacks counts 0 rows there. Equal counts with a changed value differ
    in the hashes of their range; each side is read once, and only sums are shuffled.
    """
    if source.keys() != target.keys():
        raise ValueError(f"tables differ: {sorted(source.keys() ^ target.keys())}")
    parts = []
    for table, df in source.items():
        columns = df.columns
        if sorted(columns) != sorted(target[table].columns):
            raise ValueError(f"{table}: columns differ: {sorted({*columns} ^ {*target[table].columns})}")
        sums = contents(columns)
        for side, rows in (("src", df), ("dst", target[table])):
            summed = rows.groupBy(F.expr(ranges[table]).cast("string").alias("key_range")).agg(
                *[value.alias(name) for name, value in sums.items()]
            )
            parts.append(summed.selectExpr(f"'{table}' as table_name", f"'{side}' as side", "*"))
    pick = "max({0}) filter (where side = '{1}')"
    both = reduce(DataFrame.unionByName, parts).groupBy("table_name", "key_range")
    paired = both.agg(
        *[
            F.expr(f"coalesce({pick.format(name, side)}, 0)").alias(f"{side}_{name}")
            for name in ("cnt", "total", "parity")
            for side in ("src", "dst")
        ]
    )
    same = " and ".join(f"src_{name} = dst_{name}" for name in ("cnt", "total", "parity"))
    return paired.selectExpr("table_name", "key_range", "src_cnt", "dst_cnt", f"{same} as ok")


def not_empty(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Whether each table has at least one row.

    Runs at once, table by table, because that way reading stops at the first row found.
    """
    spark = next(iter(tables.values())).sparkSession
    filled = [not df.isEmpty() for df in tables.values()]
    return spark.createDataFrame(pa.table({"table_name": list(tables), "ok": filled}))


def required_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count of each required column, all columns in one pass."""
    counts = df.agg(*[F.expr(f"count_if({c} is null) as {c}") for c in columns])
    lines = ", ".join(f"named_struct('column_name', '{c}', 'null_cnt', {c})" for c in columns)
    return counts.selectExpr(f"inline(array({lines}))").selectExpr("*", "null_cnt = 0 as ok")


def observe_nulls(df: DataFrame, columns: Sequence[str], seen: Observation) -> DataFrame:
    """``df`` whose NULLs in ``columns`` are counted by whatever action next computes its rows."""
    if not columns:
        return df
    return df.observe(seen, *[F.expr(f"count_if({c} is null) as {c}") for c in columns])


def require_none(counts: Mapping[str, int], optional: Sequence[str], what: str) -> None:
    """Raise with the columns that have NULLs and are not ``optional``."""
    found = {c: n for c, n in counts.items() if n and c not in optional}
    if found:
        raise CheckFailed(f"{what}: {', '.join(f'{c}: {n}' for c, n in found.items())}")


def observed_nulls(
    spark: SparkSession,
    counts: Mapping[str, Mapping[str, int]],
    optional: Mapping[str, Sequence[str]],
) -> DataFrame:
    """Observed NULL counts, one line per table and column; optional columns may have some."""
    lines = [(t, c, c in optional[t], n) for t, columns in counts.items() for c, n in columns.items()]
    types = {
        "table_name": pa.string(),
        "column_name": pa.string(),
        "is_optional": pa.bool_(),
        "null_cnt": pa.int64(),
    }
    columns = zip(types, zip(*lines, strict=True), strict=True) if lines else ((c, ()) for c in types)
    found = pa.table({c: pa.array(values, types[c]) for c, values in columns})
    return spark.createDataFrame(found).selectExpr("*", "is_optional or null_cnt = 0 as ok")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Lookup keys held by more than one row, with their row count. NULL keys never match, so they never count."""
    known = " and ".join(f"{c} is not null" for c in key)
    return df.where(known).groupBy(*key).agg(F.count("*").alias("row_cnt")).where("row_cnt > 1")


def require(check: DataFrame, what: str) -> None:
    """Raise with the count and the first lines that violate a check with an ``ok`` column."""
    broken = check.where("not ok")
    shown = broken.limit(SHOWN).collect()
    if shown:
        lines = "; ".join(str(row.asDict()) for row in shown)
        raise CheckFailed(f"{what}: {lines}; {broken.count()} in all")
