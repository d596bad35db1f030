"""Foreign-key resolution against dimensions and other facts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORPHAN_POLICIES = ("keep", "drop", "fail")
#: Bytes in memory of the largest dimension that may be broadcast, which the driver collects and hashes.
BROADCAST_BYTES = 32 * 1024 * 1024


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    current: bool = False,
    orphans: str = "keep",
    rows: int | None = None,
) -> DataFrame:
    """Add ``take`` (new name -> dimension column) where every ``on`` pair matches.

    NULL keys match nothing. ``current`` narrows the dimension to its current rows before
    the join. Rows without a match keep NULLs, are dropped, or fail the job. A key that
    the dimension holds twice multiplies the row, as a plain join does.

    A small dimension is broadcast by its measured size, a large one is shuffled, where adaptive
    execution splits the partition of a hot key. Before it runs, Spark takes the size of the
    compressed files for that of the rows, which may be thirty times as large in the driver; ``rows``,
    where the caller knows how many the dimension has, keeps such a one from being broadcast.
    """
    if orphans not in ORPHAN_POLICIES:
        raise ValueError(f"orphans must be one of {ORPHAN_POLICIES}, not {orphans!r}")
    if current:
        dim = dim.where("is_current_flag")
    keys = {column: f"_key_{i}" for i, column in enumerate(on.values())}
    side = dim.selectExpr(
        *[f"{column} as {name}" for column, name in keys.items()],
        *[f"{column} as {name}" for name, column in take.items()],
    )
    if rows is not None and rows * _row_bytes(side) > BROADCAST_BYTES:
        side = side.hint("merge")
    matches = " and ".join(f"{left} = {keys[right]}" for left, right in on.items())
    joined = df.join(side, F.expr(matches), "inner" if orphans == "drop" else "left")
    if orphans == "fail":
        for name in take:
            missing = F.raise_error(F.lit(f"no {name} for this row")).cast(joined.schema[name].dataType)
            joined = joined.withColumn(name, F.coalesce(F.col(name), missing))
    return joined.drop(*keys.values())


def _row_bytes(df: DataFrame) -> int:
    """What Spark takes a row of such columns to need in memory."""
    return 8 + df._jdf.schema().defaultSize()
