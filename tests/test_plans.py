"""The physical plans are the ones wanted: pruned, pushed down, no single task, no Python."""

from __future__ import annotations

import re

import pytest

from lamina.operators.metrics import activity
from lamina.plans.access import LOGIN_METRICS, ROLE_METRICS
from lamina.plans.build import MARTS, TABLES, VIEWS, warehouse
from testbed.bindings import store_raw_layer, stored_raw_table
from testbed.queries import open_warehouse


@pytest.fixture(scope="module")
def wh(spark, sf_dir):
    store_raw_layer(spark, sf_dir)
    return open_warehouse(spark, sf_dir)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(TABLES))
def test_rows_never_gather_in_one_task(wh, name):
    found = plan(wh.rows(name))
    for operator in ("SinglePartition", "BroadcastNestedLoopJoin", "CartesianProduct", "Python", "Window"):
        assert operator not in found


@pytest.mark.parametrize("name", sorted({**MARTS, **VIEWS}))
def test_reports_are_native_and_distributed(wh, name):
    found = plan(wh.report(name))
    for operator in ("SinglePartition", "BroadcastNestedLoopJoin", "CartesianProduct", "Python"):
        assert operator not in found


def scans(df) -> list[str]:
    return re.findall(r"FileScan parquet \[([^\]]*)\]", plan(df))


def test_signal_predicates_reach_the_scan(wh):
    pushed = df_filters(wh.rows("finance.fct_employee_finance_signal"))
    for flag in ("suspicious_flag", "manual_flag", "urgent_flag"):
        assert any(f"EqualTo({flag},Y)" in filters for filters in pushed), flag


def df_filters(df) -> list[str]:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    return re.findall(r"PushedFilters: \[(.*)\]", text)


def test_factors_scan_each_event_source_once(wh):
    events = [s for s in scans(wh.rows("risk.fct_employee_risk_factor")) if "employee_src_id" in s]
    # Four event sources and the employee dimension they are resolved against.
    assert len(events) == 5


def test_metrics_read_only_their_columns(wh):
    found = scans(wh.rows("hr.fct_employee_hr_snapshot"))
    absences = next(s for s in found if "duration_days" in s)
    assert len(absences.split(",")) == 2


def test_entity_joins_share_one_partitioning(wh, confs):
    confs(autoBroadcastJoinThreshold="-1")
    found = plan(wh.rows("risk.fct_employee_risk_snapshot"))
    # One exchange per side of the join and one for the factors' own aggregation by employee.
    assert "SortMergeJoin" in found
    assert len(re.findall(r"Exchange hashpartitioning\(employee_id#\d+L, ", found)) <= 3


CATALOGUES = (
    "hr.dim_position",
    "risk.dim_risk_event_type",
    "access.dim_access_system",
    "access.dim_access_role",
    "finance.dim_finance_cost_center",
    "finance.dim_finance_vendor",
)


@pytest.mark.parametrize("name", CATALOGUES)
def test_catalogues_hash_every_scanned_row(spark, sf_dir, wh, name):
    lines = plan(open_warehouse(spark, sf_dir).rows(name)).splitlines()
    first = []
    for at, line in enumerate(lines):
        if "FileScan" in line:
            first += [upper for upper in _above(lines, at) if "Aggregate" in upper][:1]
    assert first
    assert all("HashAggregate" in upper for upper in first)


def _above(lines: list[str], at: int):
    """The operators over a line of a plan, nearest first."""
    depth = _depth(lines[at])
    for line in reversed(lines[:at]):
        if _depth(line) < depth:
            depth = _depth(line)
            yield line


def _depth(line: str) -> int:
    return re.search(r"[A-Za-z*]", line).start()


COUNTED = {
    "access.fct_employee_role_assignment": ROLE_METRICS,
    "access.fct_employee_login_event": LOGIN_METRICS,
}


@pytest.mark.parametrize("name", COUNTED)
def test_counts_need_no_keys_of_tables_they_take_nothing_from(spark, sf_dir, name):
    """An account held twice still counts its assignments and logins twice."""
    store_raw_layer(spark, sf_dir)

    def raw(table):
        df = stored_raw_table(spark, sf_dir, table)
        twice = table == "access_system_accounts_raw"
        return df.unionByName(df.where("src_account_id like '%7'")) if twice else df

    wh, whole = warehouse(raw), warehouse(raw)
    found = wh.measured(name, "employee_id", COUNTED[name])
    assert not [t for t in wh._tables if t.startswith("access.")]
    expected = activity(whole.rows(name), "employee_id", COUNTED[name])
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    single = open_warehouse(spark, sf_dir).measured(name, "employee_id", COUNTED[name])
    assert sorted(map(str, found.collect())) != sorted(map(str, single.collect()))
