"""What the driver holds while a warehouse is built stays small, however many tables and files there are."""

from __future__ import annotations

from threading import Lock
from time import sleep

import pytest

from lamina.operators import lookups, parallel
from lamina.operators.lookups import lookup
from lamina.operators.parallel import side_by_side
from lamina.operators.staging import KEPT_LISTS, new_path, stage
from lamina.plans import base
from lamina.plans.build import warehouse
from lamina.sources.files import read_table, write_table
from testbed.bindings import stored_raw_table
from testbed.queries import open_warehouse


def test_nested_work_holds_few_threads_at_once(spark):
    lock, now, most = Lock(), [0], [0]

    def leaf(n: int) -> int:
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        sleep(0.02)
        with lock:
            now[0] -= 1
        return n * n

    assert side_by_side(lambda k: side_by_side(leaf, range(k, k + 6)), range(4)) == [
        [n * n for n in range(k, k + 6)] for k in range(4)
    ]
    assert 1 < most[0] <= 1 + parallel.HELPERS
    # Every helper is free again.
    assert all(parallel._helpers.acquire(blocking=False) for _ in range(parallel.HELPERS))
    parallel._helpers.release(parallel.HELPERS)


def test_the_first_failure_is_raised_and_nothing_begins_after_it(spark):
    begun = []

    def work(n: int) -> None:
        begun.append(n)
        sleep(0.05)
        if n >= 2:
            raise ValueError(n)

    with pytest.raises(ValueError, match="^2$"):
        side_by_side(work, range(50))
    assert len(begun) < 10
    assert side_by_side(str, range(5)) == ["0", "1", "2", "3", "4"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def keeps_file_list(df) -> bool:
    """Whether the list of the files that the scan reads stays in Spark's cache after it."""
    index = df._jdf.queryExecution().analyzed().collectLeaves().head().relation().location()
    fields = [f for f in index.getClass().getDeclaredFields() if f.getName().endswith("fileStatusCache")]
    fields[0].setAccessible(True)
    return "NoopCache" not in fields[0].get(index).getClass().getName()


def test_file_lists_go_with_the_scans(spark, tmp_path):
    asked = spark.conf.get(KEPT_LISTS, None)
    rows = spark.range(20).repartition(4)
    path = new_path(spark, "listed")
    write_table(rows, path)
    assert keeps_file_list(spark.read.parquet(path))
    found = [read_table(spark, path, rows.schema), stage(rows, "listed")]
    assert [keeps_file_list(df) for df in found] == [False, False]
    assert [df.count() for df in found] == [20, 20]
    assert spark.conf.get(KEPT_LISTS, None) == asked


def test_a_stored_table_leaves_no_plan_of_its_rows(spark, sf_dir, tmp_path, monkeypatch):
    collected = []
    monkeypatch.setattr(base, "let_go", lambda session: collected.append(dict(wh._rows)))

    def store(name, df):
        write_table(df, f"{tmp_path}/{name}")
        return read_table(spark, f"{tmp_path}/{name}", df.schema)

    wh = warehouse(lambda table: stored_raw_table(spark, sf_dir, table), store=store)
    keyed = wh.table("hr.dim_hr_department")
    assert collected == [{}]
    assert wh.table("hr.dim_hr_department") is keyed
    assert wh.rows("hr.dim_hr_department") is keyed
    assert keyed.count() == keyed.select("department_id").distinct().count() > 0


def test_a_dimension_that_only_its_files_make_small_is_not_broadcast(spark, confs):
    """Small files hold 1.4 million rows, which take more than the driver should collect."""
    confs(autoBroadcastJoinThreshold="10MB")
    n = lookups.BROADCAST_BYTES // 24 + 1
    dim = stage(spark.range(n).selectExpr("id div 1000 as code", "id as key", "repeat('x', 50) as a", "'y' as b"), "dim")
    facts = spark.range(3).selectExpr("id * 1150 as code")
    taken = lookup(facts, dim, {"code": "code"}, {"key": "key"}, rows=n)
    assert "SortMergeJoin" in plan_of(taken) and "BroadcastHashJoin" not in plan_of(taken)
    few = lookup(facts, dim.where("code = 1150"), {"code": "code"}, {"key": "key"}, rows=1000)
    assert "BroadcastHashJoin" in plan_of(few)
    assert "BroadcastHashJoin" in plan_of(lookup(facts, dim, {"code": "code"}, {"key": "key"}))
    found = taken.groupBy("code").agg({"key": "count"}).collect()
    assert sorted(map(tuple, found)) == [(0, 1000), (1150, 1000), (2300, 0)]


def test_lookups_of_a_warehouse_know_the_rows_of_their_dimensions(spark, sf_dir, monkeypatch, confs):
    confs(autoBroadcastJoinThreshold="10MB")
    name = "hr.fct_employee_absence"
    assert "SortMergeJoin" not in plan_of(open_warehouse(spark, sf_dir).rows(name))
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 0)
    wh = open_warehouse(spark, sf_dir)
    assert "BroadcastHashJoin" not in plan_of(wh.rows(name))
    assert wh._counts["hr.dim_hr_employee"] == wh.table("hr.dim_hr_employee").count()
