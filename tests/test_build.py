from __future__ import annotations

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lamina.functions import decode_epoch_ts
from lamina.operators import keys
from lamina.operators.quality import CheckFailed
from lamina.operators.staging import new_path, release_staging, shared_folder, staging_folder
from lamina.plans import build, publishing
from lamina.plans.build import (
    MARTS,
    TABLES,
    VIEWS,
    build_all,
    check_required,
    current_run,
    entity_buckets,
    last_version,
    migrate,
    publish,
    read_checks,
    read_published,
    register_views,
    stored_raw,
)
from lamina.plans.publishing import PublishConflict
from lamina.sources.schemas import table_schema
from testbed.bindings import store_raw_layer, stored_raw_table


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    store_raw_layer(spark, sf_dir)
    return lambda table: stored_raw_table(spark, sf_dir, table)


@pytest.fixture(scope="module")
def built(spark, raw, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    return root, build_all(spark, raw, root, "r1")


def test_build_publishes_every_table(spark, built):
    root, wh = built
    assert current_run(spark, root) == "r1"
    assert (len(TABLES), len(MARTS), len(VIEWS)) == (27, 4, 4)
    for name in (*TABLES, *MARTS):
        stored = read_published(spark, root, name)
        assert stored.columns == table_schema(name).names
        assert not stored.isEmpty(), name


def test_stored_build_equals_the_unstored_one(spark, raw, built):
    root, _ = built
    fresh = build.warehouse(raw)
    for name in MARTS:
        stored, derived = read_published(spark, root, name), fresh.report(name)
        assert stored.exceptAll(derived).isEmpty(), name
        assert derived.exceptAll(stored).isEmpty(), name


def test_views_are_registered(spark, built):
    _, wh = built
    assert register_views(wh, ["hr", "risk"]) == [
        "hr.v_employee_instability_signals",
        "risk.v_employee_risk_trend",
    ]
    employees = spark.sql("select count(distinct employee_id) from v_employee_risk_trend").first()[0]
    assert employees == wh.table("risk.dim_employee").count()


def test_surrogate_keys_are_dense(spark, built):
    root, _ = built
    for name, plan in TABLES.items():
        row = read_published(spark, root, name).agg(
            F.min(plan.key), F.max(plan.key), F.count("*"), F.count_distinct(plan.key)
        ).first()
        assert row[0] == 1 and row[1] == row[2] == row[3], name


def test_access_needs_hr_in_the_same_run(spark, raw, tmp_path):
    with pytest.raises(CheckFailed, match="access needs the hr dimensions"):
        build_all(spark, raw, str(tmp_path), "r1", subjects=["access"])


def test_failed_checks_leave_the_published_run_alone(spark, raw, tmp_path):
    root = str(tmp_path)
    publish(spark, root, "before", "runs/before")

    def no_employees(table):
        return raw(table).where("employee_src_id is null") if table == "hr_employee_master_raw" else raw(table)

    with pytest.raises(CheckFailed, match="hr marts are empty"):
        build_all(spark, no_employees, root, "after", subjects=["hr"])
    assert current_run(spark, root) == "before"


def test_nulls_in_required_columns_are_refused(raw):
    check_required(raw, "hr")

    def broken(table):
        return raw(table).withColumn("batch_id", F.lit(None).cast("string"))

    with pytest.raises(CheckFailed, match="NULLs in required columns: .*batch_id"):
        check_required(broken, "hr")


def test_migration_moves_decodes_and_counts(spark, raw, tmp_path):
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    logins = raw("access_login_events_raw")
    source = {
        "access_login_events_raw": logins.withColumn(
            "login_dttm", F.timestamp_diff("MICROSECOND", epoch, F.col("login_dttm"))
        ),
        "hr_department_history_raw": raw("hr_department_history_raw"),
    }
    decode = {"access_login_events_raw": {"login_dttm": decode_epoch_ts}}
    target = str(tmp_path / "target")
    parity = migrate(spark, source, str(tmp_path / "staging"), target, decode)
    assert {r["table_name"]: r["ok"] for r in parity.collect()} == dict.fromkeys(source, True)
    moved = stored_raw(spark, target)("access_login_events_raw")
    assert moved.exceptAll(logins).isEmpty() and logins.exceptAll(moved).isEmpty()


def test_migration_raises_on_lost_rows(spark, raw, tmp_path, monkeypatch):
    whole = build.export_raw
    monkeypatch.setattr(build, "export_raw", lambda df, path: whole(df.where("org_level = 1"), path))
    source = {"hr_department_history_raw": raw("hr_department_history_raw")}
    with pytest.raises(CheckFailed, match="row counts differ"):
        migrate(spark, source, str(tmp_path / "staging"), str(tmp_path / "target"))


def test_staging_lives_in_the_folder_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    path = new_path(spark, "probe")
    assert path.startswith(staging_folder(spark))


class BareSession:
    """A session that names a master and nothing else."""

    class sparkContext:  # noqa: N801
        folder = None

        @classmethod
        def getCheckpointDir(cls):  # noqa: N802
            return cls.folder

    def __init__(self, master):
        self.conf = {"spark.master": master}


@pytest.mark.parametrize("master", ["yarn", "local[2]", "local-cluster[2,1,1024]"])
def test_staging_needs_a_named_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(BareSession(master))


def test_staging_takes_the_folder_of_the_context(monkeypatch):
    monkeypatch.setattr(BareSession.sparkContext, "folder", "/shared/c/")
    assert shared_folder(BareSession("yarn")) == "/shared/c"


def test_a_failed_build_leaves_the_published_run_of_its_name(spark, raw, tmp_path):
    root = str(tmp_path)
    name = "hr.employee_hr_profile_report"
    before = len(_staged_keys(spark))
    build_all(spark, raw, root, "r1", subjects=["hr"])
    assert len(_staged_keys(spark)) == before  # released once the tables are stored
    rows = read_published(spark, root, name).count()
    assert rows == 150

    def no_employees(table):
        return raw(table).where("employee_src_id is null") if table == "hr_employee_master_raw" else raw(table)

    with pytest.raises(CheckFailed):
        build_all(spark, no_employees, root, "r1", subjects=["hr"])
    assert current_run(spark, root) == "r1"
    assert read_published(spark, root, name).count() == rows


def _staged_keys(spark):
    folder = Path(staging_folder(spark).removeprefix("file:"))
    names = ("key-", "rows-", "activity-")
    return [p for p in folder.iterdir() if p.name.startswith(names)] if folder.is_dir() else []


EVENTS = {
    "hr": ["hr/dds/fct_employee_activity_signal"],
    "risk": ["risk/dds/fct_risk_event"],
    "access": ["access/dds/fct_employee_access_signal"],
    "finance": ["finance/dds/fct_employee_finance_signal"],
}


def test_a_build_reads_each_signal_table_once(spark, raw, tmp_path, monkeypatch, confs):
    """What marts say of signals was kept by the pass that counted them for the snapshot."""
    confs(maxMetadataStringLength="10000")
    plans = []

    def spying(work):
        def run(df, *args, **options):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return work(df, *args, **options)

        return run

    monkeypatch.setattr(build, "write_table", spying(build.write_table))
    monkeypatch.setattr(keys, "_stage_levels", spying(keys._stage_levels))
    build_all(spark, raw, str(tmp_path), "r1")
    for tables in EVENTS.values():
        for table in tables:
            scans = [line for p in plans for line in p.splitlines() if "FileScan" in line and f"/{table}]" in line]
            assert len(scans) == 1, table


def test_marts_without_a_store_read_what_was_counted_once(spark, raw):
    wh = build.warehouse(raw)
    for name in MARTS:
        plan = wh.report(name)._jdf.queryExecution().executedPlan().toString()
        assert "max(" not in plan, name  # last times are read, not computed anew


def test_orphans_are_kept_or_refused(spark, raw, built, tmp_path):
    root, _ = built
    checks = read_checks(spark, root).where("null_cnt > 0")
    assert {(r.table_name, r.column_name) for r in checks.collect()} >= {("hr.fct_employee_absence", "employee_id")}
    assert checks.where("not ok").isEmpty()
    with pytest.raises(CheckFailed, match=r"hr\..* has NULLs in required columns: (position_code|employee_id): "):
        build_all(spark, raw, str(tmp_path), "r1", subjects=["hr"], refuse_orphans=True)
    with pytest.raises(FileNotFoundError):
        current_run(spark, str(tmp_path))


def test_nulls_in_required_detail_columns_are_refused(spark, raw, tmp_path, monkeypatch):
    plan = TABLES["hr.fct_employee_absence"]
    rows = lambda wh: plan.rows(wh).withColumn("start_date", F.expr("if(duration_days > 3, null, start_date)"))
    monkeypatch.setitem(TABLES, "hr.fct_employee_absence", replace(plan, rows=rows))
    with pytest.raises(CheckFailed, match="hr.fct_employee_absence has NULLs in required columns: start_date: "):
        build_all(spark, raw, str(tmp_path), "r1", subjects=["hr"])


def test_of_two_builds_at_once_one_is_refused(spark, raw, tmp_path):
    root = str(tmp_path)
    begun = []

    def slow(table):
        if not begun:
            begun.append(table)
            build_all(spark, raw, root, "faster", subjects=["hr"])
        return raw(table)

    with pytest.raises(PublishConflict, match="slower: version 1 was published"):
        build_all(spark, slow, root, "slower", subjects=["hr"])
    assert begun and current_run(spark, root) == "faster"
    build_all(spark, raw, root, "next", subjects=["hr"])
    assert current_run(spark, root) == "next"


def test_versions_need_no_clock_and_pass_over_half_written_ones(spark, tmp_path):
    root = str(tmp_path)
    assert last_version(spark, root) == 0
    assert [publish(spark, root, f"r{k}", f"runs/{k}") for k in range(12)] == list(range(1, 13))
    assert current_run(spark, root) == "r11"
    (tmp_path / "published" / f"{13:020d}").touch()  # a writer that died
    assert current_run(spark, root) == "r11"
    with pytest.raises(PublishConflict):
        publish(spark, root, "late", "runs/late", based_on=12)
    assert publish(spark, root, "r13", "runs/13", buckets={"a.b": ("c", 4)}) == 14
    found = publishing.current(spark, root)
    assert (found.version, found.run_id, found.buckets) == (14, "r13", {"a.b": ("c", 4)})


def test_marts_of_a_bucketed_build_join_without_a_shuffle(spark, raw, tmp_path, confs, built):
    wh = build_all(spark, raw, str(tmp_path), "r1", buckets=entity_buckets(4))
    plain_root, _ = built
    for name in MARTS:
        stored, plain = (read_published(spark, r, name) for r in (str(tmp_path), plain_root))
        assert stored.exceptAll(plain).isEmpty() and plain.exceptAll(stored).isEmpty(), name
    # Positions and departments are small enough to send, people and snapshots are not.
    confs(autoBroadcastJoinThreshold="6000")
    for name in MARTS:
        plan = wh.report(name)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan, name
    again = read_published(spark, str(tmp_path), "risk.fct_employee_risk_snapshot")
    grouped = again.groupBy("employee_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in grouped and "Exchange" not in grouped
    assert len(again.inputFiles()) == 4


def test_migration_finds_changed_contents(spark, raw, tmp_path, monkeypatch):
    table = "access_login_events_raw"
    source = {table: raw(table)}
    ranges = {table: "substr(src_login_event_id, 1, 10)"}
    migrate(spark, source, str(tmp_path / "s"), str(tmp_path / "t"), ranges=ranges)
    whole, seen = build.load_raw, raw(table).selectExpr("min(src_login_event_id)").first()[0]

    def altered(spark, files, target, *rest):
        loaded = whole(spark, files, target, *rest)
        return loaded.withColumn("city_name", F.expr(f"if(src_login_event_id = '{seen}', 'x', city_name)"))

    monkeypatch.setattr(build, "load_raw", altered)
    with pytest.raises(CheckFailed, match=f"contents differ after migration: .*'{seen[:10]}'.*; 1 in all"):
        migrate(spark, source, str(tmp_path / "s2"), str(tmp_path / "t2"), ranges=ranges)


def test_release_deletes_only_this_application(spark, monkeypatch, tmp_path):
    monkeypatch.setattr("lamina.operators.staging.shared_folder", lambda _: str(tmp_path))
    spark.range(1).write.parquet(new_path(spark, "probe"))
    (tmp_path / "lamina" / "other").mkdir()
    assert release_staging(spark)
    assert [p.name for p in (tmp_path / "lamina").iterdir()] == ["other"]
