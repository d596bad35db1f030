"""What several operators of this package share: table reads, folds and staged tables."""

from __future__ import annotations

import math
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.operators.staging import stage

#: Separators of words in Java and DuckDB patterns.
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of rows that are sent to a Python worker at a time, so that long texts do not add up.
ARROW_BYTES = 8_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables. Python workers find this package where the driver did."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id's text leaves ``remainder``; false for a null id."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % F.lit(modulus) == F.lit(remainder), F.lit(False))


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes in the ``text`` column of the whole table."""
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def parts_for(total: int, each: int) -> int:
    """How many parts of ``each`` hold ``total``, one at least."""
    return max(1, math.ceil(total / each))


def pin(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder, so that a lost executor loses none of them."""
    return stage(df, label)


def if_small(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """``df`` marked for broadcast if a count proves it to have at most ``rows`` short rows.

    Otherwise Spark joins it as it is, with the same result.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
