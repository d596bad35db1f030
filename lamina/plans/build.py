"""Building and publishing the warehouse, and moving its raw layer between stores.

A build writes every table under a new run folder and publishes the run only after its
checks pass, so readers see either the previous run or a complete new one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lamina.operators.parallel import side_by_side
from lamina.operators.quality import (
    CheckFailed,
    content_parity,
    not_empty,
    observe_nulls,
    observed_nulls,
    require,
    require_none,
    required_nulls,
    row_parity,
)
from lamina.plans import access, finance, hr, risk
from lamina.plans.base import Run, Store, Warehouse
from lamina.plans.publishing import current, last_version, publish
from lamina.sources.files import (
    decoded,
    epoch_decoders,
    export_raw,
    load_raw,
    read_bucketed,
    read_table,
    save_bucketed,
    write_table,
)
from lamina.sources.schemas import SUBJECTS, raw_schema, raw_tables, required, table_schema

_AREAS = {"hr": hr, "risk": risk, "access": access, "finance": finance}
# Access and finance resolve employees against the hr dimensions.
NEEDS_HR = ("access", "finance")

TABLES = {name: plan for area in _AREAS.values() for name, plan in area.TABLES.items()}
MARTS = {name: plan for area in _AREAS.values() for name, plan in area.MARTS.items()}
VIEWS = {name: plan for area in _AREAS.values() for name, plan in area.VIEWS.items()}
ACTIVITIES = {name: plan for area in _AREAS.values() for name, plan in area.ACTIVITIES.items()}


def warehouse(
    raw: Callable[[str], DataFrame], run: Run | None = None, store: Store | None = None
) -> Warehouse:
    """A warehouse over stored raw tables; nothing is built until it is asked for."""
    return Warehouse(raw, TABLES, {**MARTS, **VIEWS}, run, store, ACTIVITIES)


def stored_raw(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """Raw tables as ``load_raw`` leaves them: one Parquet table per name under ``folder``."""
    return lambda table: read_table(spark, f"{folder}/{table}", raw_schema(table))


def _place(name: str) -> str:
    """Folder of a table within its run: subject, layer, table."""
    subject, table = name.split(".")
    layer = "dm" if name in MARTS else "agg" if name in ACTIVITIES else "dds"
    return f"{subject}/{layer}/{table}"


def check_required(raw: Callable[[str], DataFrame], subject: str) -> None:
    """Refuse raw tables with NULLs in required columns."""

    def check(table: str) -> None:
        nulls = required_nulls(raw(table), required(raw_schema(table)))
        require(nulls, f"{table} has NULLs in required columns")

    side_by_side(check, raw_tables(subject))


def build_all(
    spark: SparkSession,
    raw: Callable[[str], DataFrame],
    root: str,
    run_id: str,
    subjects: Iterable[str] = SUBJECTS,
    run: Run | None = None,
    layouts: Mapping[str, str] | None = None,
    buckets: Mapping[str, tuple[str, int]] | None = None,
    refuse_orphans: bool = False,
) -> Warehouse:
    """Build, check and publish subject areas, in dependency order, as one run.

    ``layouts`` names, for tables that deserve one more shuffle, the column to lay them out by, and
    ``buckets`` those to store in a number of buckets by a column, so that joins on it need no shuffle
    (``entity_buckets``). NULLs in required columns of detail tables are counted while the tables
    are written, and refused but for orphans that a plan keeps, with ``refuse_orphans`` those too;
    the counts are published with the run.

    Every attempt writes a folder of its own, so a build that fails under the name of a published
    run leaves that run as it is, and one that ends after another was published is refused.

    Surrogate keys change between runs, so tables of one run only fit each other; subject
    areas that share dimensions belong in the same run.
    """
    based_on = last_version(spark, root)
    chosen = [subject for subject in SUBJECTS if subject in set(subjects)]
    folder = f"runs/{run_id}/{uuid.uuid4().hex}"
    bucketed = dict(buckets or {})
    nulls: dict[str, dict[str, int]] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        path = f"{root}/{folder}/{_place(name)}"
        schema = df.schema if name in ACTIVITIES else table_schema(name)
        watched = required(schema) if name in TABLES else []
        seen = Observation()
        checked = observe_nulls(df, watched, seen)
        if name in bucketed:
            key, number = bucketed[name]
            save_bucketed(checked, bucket_table(path), path, key, number)
        else:
            write_table(checked, path, (layouts or {}).get(name))
        if watched:
            nulls[name] = seen.get
            kept = () if refuse_orphans else TABLES[name].optional
            require_none(nulls[name], kept, f"{name} has NULLs in required columns")
        return read_stored(spark, path, schema, bucketed.get(name))

    wh = warehouse(raw, run, store)

    def build(subject: str) -> None:
        if subject in NEEDS_HR:
            if "hr" not in chosen:
                raise CheckFailed(f"{subject} needs the hr dimensions of the same run")
            employees = {"hr.dim_hr_employee": wh.table("hr.dim_hr_employee")}
            require(not_empty(employees), f"{subject} needs hr employees")
        check_required(raw, subject)
        wh.ensure(_AREAS[subject].TABLES)
        marts = {name: store(name, wh.report(name)) for name in _AREAS[subject].MARTS}
        require(not_empty(marts), f"{subject} marts are empty")

    side_by_side(build, [subject for subject in chosen if subject == "hr"])
    side_by_side(build, [subject for subject in chosen if subject != "hr"])
    optional = {name: TABLES[name].optional for name in nulls}
    write_table(observed_nulls(spark, nulls, optional).coalesce(1), f"{root}/{folder}/{CHECKS}")
    stored = {name: bucketed[name] for name in bucketed if name.split(".")[0] in chosen}
    publish(spark, root, run_id, folder, based_on, stored)
    return wh


#: Folder of a run with the NULL counts of its detail tables.
CHECKS = "checks/required_columns"


def entity_buckets(number: int, subjects: Iterable[str] = SUBJECTS) -> dict[str, tuple[str, int]]:
    """``buckets`` for the tables that marts join on the employee."""
    wanted = set(subjects)
    names = [*TABLES, *ACTIVITIES]
    joined = [n for n in names if n.endswith(("_snapshot", "dim_hr_employee", "dim_employee")) or n in ACTIVITIES]
    return {name: ("employee_id", number) for name in joined if name.split(".")[0] in wanted}


def read_stored(
    spark: SparkSession, path: str, schema: StructType, buckets: tuple[str, int] | None = None
) -> DataFrame:
    """Scan of a stored table; a bucketed one keeps its layout in the plan."""
    if buckets is None:
        return read_table(spark, path, schema)
    return read_bucketed(spark, bucket_table(path), path, schema, *buckets)


def bucket_table(path: str) -> str:
    """Name of a bucketed table in the session's catalogue: one per stored table."""
    run, subject, _, table = path.rstrip("/").split("/")[-4:]
    return f"lamina_{run}_{subject}_{table}"


def current_run(spark: SparkSession, root: str) -> str:
    """The run published last."""
    return current(spark, root).run_id


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A detail table or mart of the current run, named ``subject.table``."""
    run = current(spark, root)
    path = f"{root}/{run.folder}/{_place(name)}"
    return read_stored(spark, path, table_schema(name), run.buckets.get(name))


def read_checks(spark: SparkSession, root: str) -> DataFrame:
    """NULL counts of the required columns of the current run's detail tables."""
    return spark.read.parquet(f"{root}/{current(spark, root).folder}/{CHECKS}")


def register_views(wh: Warehouse, subjects: Iterable[str] = SUBJECTS) -> list[str]:
    """Create the report views of the subject areas in the session, by their plain names."""
    names = [name for name in VIEWS if name.split(".")[0] in set(subjects)]
    for name in names:
        wh.report(name).createOrReplaceTempView(name.split(".")[1])
    return names


def migrate(
    spark: SparkSession,
    source: Mapping[str, DataFrame],
    staging: str,
    target: str,
    decode: Mapping[str, Mapping[str, Callable[[str], Column]]] | None = None,
    ranges: Mapping[str, str] | None = None,
) -> DataFrame:
    """Move raw tables between stores through Parquet files and verify their rows.

    Times and dates that arrive as epoch integers are decoded; ``decode`` replaces, per table,
    the functions of ``epoch_decoders``. Source rows are counted while they are exported. Returns
    the parity table; a count that differs raises instead.

    For the tables that ``ranges`` names, contents are compared as well: the decoded rows of the
    source against the target's, by the ranges that its SQL expression gives; a range with other
    rows raises. That reads the source once more and the target once.
    """
    exported: dict[str, Observation] = {}

    def decoders(table: str) -> dict[str, Callable[[str], Column]]:
        return {**epoch_decoders(table), **(decode or {}).get(table, {})}

    def move(table: str) -> DataFrame:
        files = f"{staging}/{table}"
        exported[table] = Observation()
        export_raw(source[table].observe(exported[table], F.count("*").alias("n")), files)
        return load_raw(spark, files, f"{target}/{table}", raw_schema(table), decoders(table))

    moved = dict(zip(source, side_by_side(move, source), strict=True))
    parity = row_parity({table: exported[table].get["n"] for table in source}, moved)
    require(parity, "row counts differ after migration")
    compared = [table for table in source if table in (ranges or {})]
    if compared:
        sent = {t: decoded(source[t], raw_schema(t), decoders(t)) for t in compared}
        require(
            content_parity(sent, {t: moved[t] for t in compared}, ranges),
            "contents differ after migration",
        )
    return parity
