"""Dense surrogate keys without pulling a table into one task or evaluating it twice."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from contextlib import AbstractContextManager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lamina.operators.staging import SMALL, delete, scan, session_option, stage, staged_path, stored_bytes

ROW = "_row"
_PLACE = "_place"
_LEVEL = "_level"
_POS = "_pos"
_SLICE = "_slice"
_WHOLE = "_whole"
_BEFORE = "_before"
# monotonically_increasing_id() keeps the partition above bit 33 and the row below it.
_SLICE_SHIFT = 33
_POS_MASK = (1 << _SLICE_SHIFT) - 1

#: Stored bytes of the rows that one task sorts: the first number up to ``SLICES`` tasks, then more,
#: so that large tables keep their number of tasks, up to the second.
SLICE_BYTES = (16 * 1024 * 1024, 256 * 1024 * 1024)
SLICES = 4000
#: Each level of the sample holds one row in eight of the level below; level 0 is the table.
LEVELS, LEVEL_BITS = 6, 3
#: Rows that place the bounds of one slice: the sample used holds so many a slice, or up to eight times that.
SAMPLE = 32
#: Files that a task may hold open at once while it writes folders by value; above 0, no sort precedes.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
#: Times keep their microseconds.
_TEXT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def tag_rows(stored: DataFrame) -> DataFrame:
    """Number the rows of a stored table so that exact copies can be told apart.

    Apply it directly above the scan of a written table: file splits are read in the
    same order by every attempt of a task, so a row keeps its number on a retry.
    """
    return stored.selectExpr("*", f"monotonically_increasing_id() as {ROW}")


def dense_key(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    keep: Sequence[str] | None = None,
    slices: int | None = None,
    slice_bytes: int | None = None,
    pinned: bool = True,
    counted: Callable[[int], None] | None = None,
) -> DataFrame:
    """``key`` = 1..N in the order of ``order_by`` (SQL expressions, NULLs last), then ``keep``.

    Rows that ``order_by`` leaves equal follow hashes of their kept values, then the row
    number of ``tag_rows``, which is dropped. ``keep`` defaults to every column.

    ``df`` is evaluated once: its rows are staged, and while they are written each gets a level, so
    that the rows of level j and above are a sample of one in 8^j, in files of their own. The sample
    of the right size places the bounds of the slices, and the staged rows are dealt to their slices,
    sorted and numbered while they are staged again in order. The number of slices follows from the
    bytes that were staged (``SLICE_BYTES``, or ``slice_bytes`` each), unless ``slices`` says it.

    A result that is read once, such as by a write, need not be ``pinned``: its rows are not staged again.
    The rows of each slice are counted over the columns that the bounds name, and whoever reads the
    result deals and sorts the staged rows, with the same numbers every time.

    The bounds are on ``order_by``, unless a value fills a slice by itself; then they are on the whole
    sort list, which ends with the row number, or without one with the place of the row in the staged
    table. So a value that fills a third of the table, or a third of the table being copies of one row,
    still spreads over many slices. The driver sees one count per level and per slice; ``counted`` gets
    the number of all rows.
    """
    spark = df.sparkSession
    columns = df.columns
    kept = [c for c in columns if c != ROW] if keep is None else list(keep)
    # A hash skips NULLs, so each column goes in with its NULL mark. It is computed from the staged
    # values where it is needed: bytes without any pattern are not worth writing and shuffling.
    marked = ", ".join(f"{c}, {c} is null" for c in kept)
    tie = f"struct(xxhash64({marked}), hash({marked}))"
    # Rows that a tagged row's number leaves equal are copies of each other.
    place = ROW if ROW in columns else _PLACE
    ordering = [*order_by, tie, place]

    placed = df if place == ROW else df.selectExpr("*", f"monotonically_increasing_id() as {_PLACE}")
    rows, path, counts = _stage_levels(placed, f"rows-{key}", place)
    if counted is not None:
        counted(counts[0])
    if slices is None:
        slices = slices_for(stored_bytes(spark, path), slice_bytes)
    sort = [F.expr(expression).asc_nulls_last() for expression in ordering]
    if slices == 1:
        dealt = sliced = rows.coalesce(1)
    else:
        enough = [j for j in range(LEVELS + 1) if counts[j] >= SAMPLE * slices]
        sample = rows.where(F.col(_LEVEL) >= max(enough, default=0))
        sliced = _dealt(rows, sample, order_by, ordering, slices)
        # A given number of partitions is never changed, so each task holds one slice.
        dealt = sliced.repartitionById(slices, F.col(_SLICE))
    in_order = dealt.sortWithinPartitions(*sort)
    row_id, within = "monotonically_increasing_id()", f"({_POS} & {_POS_MASK}) + 1"
    if pinned:
        staged = stage(in_order.selectExpr(*kept, f"{row_id} as {_POS}"), f"key-{key}")
        delete(spark, path)
        placed = sliced = staged.selectExpr("*", f"{_POS} >> {_SLICE_SHIFT} as {_SLICE}")
    else:
        placed = in_order.selectExpr("*", f"{row_id} as {_POS}")
    if slices == 1:
        return placed.selectExpr(f"{within} as {key}", *kept)
    before = F.broadcast(_rows_before(sliced))
    return placed.join(before, _SLICE).selectExpr(f"{within} + {_BEFORE} as {key}", *kept)


def _dealt(
    rows: DataFrame, sample: DataFrame, order_by: Sequence[str], ordering: Sequence[str], slices: int
) -> DataFrame:
    """The staged rows with their slice. Bounds on ``order_by`` will do unless a value fills a slice."""
    whole = _order_key(order_by)
    bounds = _bounds(sample, whole, slices, apart=True)
    if bounds is None:
        whole = _order_key(ordering)
        bounds = _bounds(sample, whole, slices)
    return _with_slice(rows, whole, bounds, slices)


def slices_for(stored: int, slice_bytes: int | None = None) -> int:
    """How many tasks sort a table of so many stored bytes."""
    least, most = SLICE_BYTES
    return max(1, math.ceil(stored / (slice_bytes or min(most, max(least, stored / SLICES)))))


def _stage_levels(df: DataFrame, label: str, place: str = _PLACE) -> tuple[DataFrame, str, list[int]]:
    """The rows staged with their level, where they are, and how many have each level or a higher one."""
    spark = df.sparkSession
    drawn = F.xxhash64(place)
    masks = [(1 << LEVEL_BITS * j) - 1 for j in range(1, LEVELS + 1)]
    level = sum((drawn.bitwiseAND(F.lit(m)) == 0).cast("int") for m in masks)
    leveled = df.withColumn(_LEVEL, level)
    seen = Observation()
    counts = [F.count_if(F.col(_LEVEL) >= j).alias(f"n{j}") for j in range(LEVELS + 1)]
    path = staged_path(spark, label)
    # One folder a level: a later read of a sample opens no file of the other rows.
    with _open_files(spark, LEVELS + 1):
        leveled.observe(seen, *counts).write.option(*SMALL).partitionBy(_LEVEL).parquet(path)
    found = seen.get
    rows = scan(spark, path, leveled.schema)
    return rows, path, [found[f"n{j}"] for j in range(LEVELS + 1)]


def _open_files(spark: SparkSession, files: int) -> AbstractContextManager[None]:
    """Writes in this block may keep so many files of a task open, instead of sorting its rows by folder."""
    most = max(files, int(spark.conf.get(OPEN_FILES, None) or 0))
    return session_option(spark, OPEN_FILES, str(most))


def _order_key(ordering: Sequence[str]) -> Column:
    """The sort list as one value; NULL marks first, because a struct sorts NULLs low."""
    parts = [e for o in ordering for e in (f"{o} is null", o)]
    return F.struct(*[F.expr(e).alias(f"k{n}") for n, e in enumerate(parts)])


def _bounds(sample: DataFrame, whole: Column, slices: int, apart: bool = False) -> Column | None:
    """Where slices 1, 2, ... begin, as one constant; with ``apart``, None where two begin alike.

    The bounds cross the driver as text. Whatever a type loses on that way moves a bound a little
    and no row out of order.
    """
    keys = sample.agg(F.sort_array(F.collect_list(whole)).alias("keys"))
    picks = F.expr(
        f"filter(transform(sequence(1, {slices - 1}), k -> get(keys, cast(k * size(keys) div {slices} as int))),"
        " b -> b is not null)"
    )
    picked = keys.select(picks.alias("bounds"))
    distinct = F.size(F.array_distinct("bounds")) == F.size("bounds")
    text, differ = picked.select(F.to_json("bounds", _TEXT), distinct).first()
    if apart and not differ:
        return None
    kind = picked.schema["bounds"].dataType
    return F.sort_array(F.from_json(F.lit(text), kind, _TEXT))


def _with_slice(rows: DataFrame, whole: Column, bounds: Column, slices: int) -> DataFrame:
    """The rows with how many bounds each has reached, by halving: 9 comparisons for 400 slices.

    Every halving is a column of its own, so that Spark compiles the comparisons; inside a function
    over the array of bounds they would be interpreted, and the sort list built anew for each.
    """
    found = rows.withColumn(_WHOLE, whole).withColumn(_SLICE, F.lit(0))
    for k in reversed(range((slices - 1).bit_length())):
        passed, width = F.col(_SLICE), 1 << k
        # A bound past the last is NULL and never reached.
        reached = F.get(bounds, passed + (width - 1)) <= F.col(_WHOLE)
        found = found.withColumn(_SLICE, F.when(reached, passed + width).otherwise(passed))
    return found.drop(_WHOLE)


def _rows_before(sliced: DataFrame) -> DataFrame:
    """Rows in earlier slices, per slice: one line for each slice that has rows."""
    counts = sliced.groupBy(F.col(_SLICE).cast("bigint").alias(_SLICE)).agg(F.expr("count(*) as n")).collect()
    counts.sort(key=lambda row: row[_SLICE])
    before, total = [], 0
    for row in counts:
        before.append(total)
        total += row["n"]
    return sliced.sparkSession.createDataFrame(
        pa.table(
            {
                _SLICE: pa.array([row[_SLICE] for row in counts], pa.int64()),
                _BEFORE: pa.array(before, pa.int64()),
            }
        )
    )
