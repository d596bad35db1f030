"""Value comparison of a Spark result with the oracle's."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

ORACLE_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """An in-process DuckDB with the test tables as views."""
    con = duckdb.connect()
    for table in ORACLE_TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        con.execute(f"create view {table} as select * from read_parquet('{path}')")
    return con


def _text(value: object) -> str:
    if isinstance(value, Decimal):
        return format(value.normalize(), "f") if value else "0"
    if isinstance(value, datetime | date):
        return value.isoformat()
    return repr(value)


def _lines(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_text(row[i]) for i in order) for row in rows)


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both results hold the same columns and rows, else what differs."""
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns differ: {sorted(set(columns) ^ set(df.columns))}"
    actual = _lines(df.columns, [tuple(row) for row in df.collect()])
    wanted = _lines(columns, expected)
    if actual == wanted:
        return None
    extra, missing = actual - wanted, wanted - actual
    return (
        f"{sorted(columns)}: {actual.total()} rows against {wanted.total()}; "
        f"extra {extra.total()} e.g. {next(iter(extra), None)}; "
        f"missing {missing.total()} e.g. {next(iter(missing), None)}"
    )
