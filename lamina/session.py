"""Session settings for warehouse builds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Bytes a shuffle partition should hold, so that sorting it fits in a task's memory share.
PARTITION_BYTES = 256 * 1024 * 1024


def partitions_for(largest_table_bytes: int, at_least: int) -> int:
    """Shuffle partitions for a table of the given size in memory, never below ``at_least``."""
    return max(at_least, -(-largest_table_bytes // PARTITION_BYTES))


def settings(shuffle_partitions: int) -> dict[str, str]:
    """What every build relies on: adaptive plans, skew splitting, UTC.

    The partition count is the starting point; adaptive execution merges small ones.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
    }


def build_session(
    app: str,
    master: str | None = None,
    shuffle_partitions: int = 200,
    extra: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with the settings above; ``master`` is for local runs only."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = (
            builder.master(master)
            .config("spark.driver.memory", "8g")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
        )
    for key, value in {**settings(shuffle_partitions), **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
