"""CSV, Parquet and JDBC scans; Parquet writes with full-refresh semantics."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import decode_epoch_date, decode_epoch_range, decode_epoch_ts
from lamina.operators.staging import SMALL, scan
from lamina.sources.schemas import conform, raw_schema

# The text formats of the raw CSV files.
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
TIMESTAMP_WRITE_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _csv_options(timestamps: str) -> dict[str, str]:
    return {
        "header": "true",
        "quote": '"',
        "escape": '"',
        "dateFormat": DATE_FORMAT,
        "timestampNTZFormat": timestamps,
    }


def nullable(schema: T.StructType) -> T.StructType:
    """The same columns with no required ones; scans do not enforce NOT NULL."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def read_raw(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """Typed scan of CSV files with a header; a missing path or a malformed line is an error.

    Files stay splittable unless ``multiline`` is set for values with line breaks in them.
    """
    return (
        spark.read.options(**_csv_options(TIMESTAMP_FORMAT))
        .option("mode", "FAILFAST")
        .option("enforceSchema", "false")
        .option("multiLine", multiline)
        .schema(nullable(schema))
        .csv(path)
    )


_LINE = "_line"


def _parsed(spark: SparkSession, path: str, schema: T.StructType, multiline: bool) -> DataFrame:
    """Typed scan that keeps the text of lines that do not parse in a column of its own."""
    whole = T.StructType([*nullable(schema), T.StructField(_LINE, T.StringType())])
    return (
        spark.read.options(**_csv_options(TIMESTAMP_FORMAT))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _LINE)
        .option("enforceSchema", "false")
        .option("multiLine", multiline)
        .schema(whole)
        .csv(path)
    )


#: A comma with an even number of quotes after it.
_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def _reason(schema: T.StructType) -> Column:
    """Why a line does not parse: its number of values, or the columns whose text is not of their type."""
    texts = ", ".join(f"c{n} string" for n in range(len(schema)))
    values = F.from_csv(F.col(_LINE), texts, {"quote": '"', "escape": '"'})
    found = F.regexp_count(F.col(_LINE), F.lit(_COMMA)) + 1
    broken = [
        F.when(
            values[f"c{n}"].isNotNull() & F.col(f.name).isNull(),
            F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), values[f"c{n}"]),
        )
        for n, f in enumerate(schema)
    ]
    return F.when(
        found != len(schema), F.concat(found.cast("string"), F.lit(f" values instead of {len(schema)}"))
    ).otherwise(F.array_join(F.array_compact(F.array(*broken)), "; "))


def load_csv(
    spark: SparkSession,
    source: str,
    target: str,
    rejects: str,
    schema: T.StructType,
    multiline: bool = False,
) -> DataFrame:
    """Replace the target table by the CSV lines that parse; returns the target.

    The others replace the table at ``rejects``: ``line`` as it stands in the file, ``reason`` and
    ``file``. Lines are parsed once, and counted then; only if some are rejected, the files are read
    a second time for them.
    """
    seen = Observation()
    bad = F.col(_LINE).isNotNull()
    parsed = _parsed(spark, source, schema, multiline)
    counted = parsed.observe(seen, F.count_if(bad).alias("n"))
    write_table(conform(counted.where(~bad), schema), target)
    lines = parsed.where(bad).select(
        F.col(_LINE).alias("line"), _reason(schema).alias("reason"), F.input_file_name().alias("file")
    )
    write_table(lines if seen.get["n"] else lines.limit(0), rejects)
    return read_table(spark, target, schema)


def write_csv(df: DataFrame, path: str) -> None:
    """Write CSV files that ``read_raw`` reads back."""
    df.write.mode("overwrite").options(**_csv_options(TIMESTAMP_WRITE_FORMAT)).csv(path)


def write_table(df: DataFrame, path: str, layout_key: str | None = None) -> None:
    """Replace the whole table at ``path``.

    With ``layout_key``, rows of one key are written together. It is a rebalance rather than
    a plain repartition: adaptive execution cuts the partition of a hot key into several files.
    """
    if layout_key is not None:
        df = df.hint("rebalance", F.col(layout_key))
    df.write.mode("overwrite").option(*SMALL).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Scan of a table written by ``write_table``, with its known layout."""
    return scan(spark, path, nullable(schema))


def save_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """Replace a catalogue table bucketed by ``key``, so joins on the key need no shuffle.

    Rows are dealt to the buckets first, so that each bucket is one file.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .format("parquet")
        .option(*SMALL)
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )


def read_bucketed(
    spark: SparkSession, table: str, path: str, schema: T.StructType, key: str, buckets: int
) -> DataFrame:
    """Scan of what ``save_bucketed`` stored, in any session: its catalogue learns the layout first."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    location = path.replace("'", "\\'")
    spark.sql(
        f"create table if not exists `{table}` ({columns}) using parquet"
        f" clustered by (`{key}`) sorted by (`{key}`) into {buckets} buckets location '{location}'"
    )
    return spark.table(f"`{table}`")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    bounds: tuple[int, int],
    partitions: int,
    properties: Mapping[str, str],
) -> DataFrame:
    """Scan of a whole database table in ``partitions`` ranges of a numeric key.

    ``bounds`` only place the ranges; rows outside them are read too.
    """
    lower, upper = bounds
    return spark.read.jdbc(
        url,
        table,
        column=key,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=dict(properties),
    )


def export_raw(df: DataFrame, path: str) -> None:
    """Write a whole raw table as Parquet; an empty one still carries its schema."""
    write_table(df, path)


class SchemaMismatch(ValueError):
    """Files hold other columns or types than the target table."""


# Subjects whose times arrive as seconds or milliseconds, told apart by their size; the others
# tell seconds, milli-, micro- and nanoseconds apart by their digits.
BY_RANGE = ("hr", "finance")


def epoch_decoders(table: str) -> dict[str, Callable[[str], Column]]:
    """For each time and date column of a raw table, the decoder of its epoch integers."""
    times = decode_epoch_range if table.split("_")[0] in BY_RANGE else decode_epoch_ts
    kinds = {T.TimestampNTZType(): times, T.DateType(): decode_epoch_date}
    return {f.name: kinds[f.dataType] for f in raw_schema(table) if f.dataType in kinds}


def load_raw(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    decode: Mapping[str, Callable[[str], Column]] | None = None,
) -> DataFrame:
    """Replace the target table by the Parquet files at ``source``; returns the target.

    Unknown and missing columns are refused, and so are columns of another type, but for integers
    that ``decode`` has a function for: e.g. ``decode_epoch_ts`` for times that arrive so.
    """
    files = spark.read.parquet(source)
    odd = set(files.columns) ^ set(schema.fieldNames())
    if odd:
        raise SchemaMismatch(f"{source}: columns on one side only: {sorted(odd)}")
    write_table(decoded(files, schema, decode, source), target)
    return read_table(spark, target, schema)


def decoded(
    df: DataFrame,
    schema: T.StructType,
    decode: Mapping[str, Callable[[str], Column]] | None = None,
    what: str = "rows",
) -> DataFrame:
    """Rows in the layout of a table; integers that ``decode`` has a function for become its type.

    Any other column of another type than the table's is refused.
    """
    wanted = {f.name: f.dataType for f in schema}
    differ = {f.name: f.dataType for f in df.schema if f.dataType != wanted[f.name]}
    columns = {
        c: function(c)
        for c, function in (decode or {}).items()
        if isinstance(differ.get(c), T.LongType | T.IntegerType)
    }
    refused = [f"{c} is {t.simpleString()}" for c, t in sorted(differ.items()) if c not in columns]
    if refused:
        raise SchemaMismatch(f"{what}: other types than the table's: {', '.join(refused)}")
    return conform(df.withColumns(columns) if columns else df, schema)
