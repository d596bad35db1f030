"""Raw tables derived from the driver's test tables, for Spark and for the SQL oracle."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from lamina.operators.parallel import side_by_side
from lamina.operators.staging import new_path
from lamina.sources.files import read_table, write_table
from lamina.sources.schemas import SUBJECTS, conform, raw_schema

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Load times of the raw batches.
LOADED_AT = {"hr": "10:00:00", "risk": "09:00:00", "access": "11:00:00", "finance": "12:00:00"}


def _read_bindings() -> dict[str, str]:
    text = (Path(__file__).parent / "raw_bindings.sql").read_text(encoding="utf-8")
    parts = re.split(r"^-- (\w+_raw)\n", text, flags=re.MULTILINE)
    return dict(zip(parts[1::2], (part.strip() for part in parts[2::2]), strict=True))


BINDINGS = _read_bindings()


def raw_sql(table: str) -> str:
    """The raw table with its audit columns, in SQL both engines run."""
    subject = next(s for s in SUBJECTS if table.startswith(f"{s}_"))
    return (
        f"select b.*, '{table.removesuffix('_raw')}' as source_system, "
        f"timestamp '2024-12-31 {LOADED_AT[subject]}' as load_dttm, "
        f"'{subject}_batch_001' as batch_id from ({BINDINGS[table]}) b"
    )


_SCANS: dict[tuple[str, str], dict[str, DataFrame]] = {}


def _scans(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    slot = (spark.sparkContext.applicationId, sf_dir)
    if slot not in _SCANS:
        _SCANS[slot] = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TEST_TABLES}
    return _SCANS[slot]


def bind(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The raw table as a plan over the Parquet test tables."""
    tables = rf"\b(from|join)\s+({'|'.join(TEST_TABLES)})\b"
    sql = re.sub(tables, r"\1 {\2} as \2", raw_sql(table))
    scans = {t: df for t, df in _scans(spark, sf_dir).items() if f"{{{t}}}" in sql}
    return conform(spark.sql(sql, **scans), raw_schema(table))


_STORED: dict[tuple[str, str, str], str] = {}


def stored_raw_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The raw table, written on first use in this application and read back from then on."""
    slot = (spark.sparkContext.applicationId, sf_dir, table)
    if slot not in _STORED:
        path = new_path(spark, table)
        write_table(bind(spark, sf_dir, table), path)
        _STORED[slot] = path
    return read_table(spark, _STORED[slot], raw_schema(table))


def store_raw_layer(spark: SparkSession, sf_dir: str) -> None:
    """Write all raw tables that this application has not written yet."""
    _scans(spark, sf_dir)
    side_by_side(lambda table: stored_raw_table(spark, sf_dir, table), BINDINGS)
