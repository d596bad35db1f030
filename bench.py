"""Times every query and the whole build at two scale factors; prints one JSON line.

The raw tables are written once first, as a warehouse has them before it builds anything;
that step is timed as ``raw_load``. Each query then runs from stored raw tables to its full
result, surrogate keys included. ``growth`` is the time at the larger scale over that at the
smaller one, whose tables are a tenth of the size.
"""

from __future__ import annotations

import importlib
import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from lamina.operators.staging import new_path, release_staging
from lamina.plans.build import build_all
from lamina.session import build_session
from testbed.bindings import store_raw_layer, stored_raw_table


def consume(df: DataFrame) -> None:
    """Compute every column of every row without keeping the result."""
    df.write.format("noop").mode("overwrite").save()


def run(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("raw_load", lambda: store_raw_layer(spark, sf_dir))
    root = new_path(spark, "warehouse")
    timed(
        "build_all",
        lambda: build_all(spark, lambda t: stored_raw_table(spark, sf_dir, t), root, "bench"),
    )
    for name, query in importlib.import_module("__spark_entry__").queries().items():
        timed(name, lambda query=query: consume(query(spark, sf_dir)))
    return seconds


def smaller(sf_dir: str) -> str | None:
    """The folder of the next smaller scale factor, if it is there."""
    parent, name = os.path.split(sf_dir.rstrip("/"))
    scale = name.removeprefix("sf").replace("0.", "0.0", 1)
    folder = os.path.join(parent, f"sf{scale}")
    return folder if name.startswith("sf0.") and os.path.isdir(folder) else None


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")},
    )
    try:
        below = smaller(sf_dir)
        before = run(spark, below) if below else {}
        seconds = run(spark, sf_dir)
        release_staging(spark)
    finally:
        spark.stop()
    result = {
        "metric": "total seconds, all queries and full build",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "smaller": before,
        "growth": {n: round(seconds[n] / t, 2) for n, t in before.items() if t},
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
