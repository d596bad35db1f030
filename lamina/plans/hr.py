"""HR: departments, positions, employees, absences, activity signals, instability."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions.flags import yes_sql
from lamina.operators.dimensions import catalog_dim, project, resolve_parent, snapshot_dim, versioned_dim
from lamina.operators.marts import with_flags
from lamina.operators.metrics import with_measures
from lamina.operators.signals import Rule, unify
from lamina.plans.base import Lookup, Scoring, Table, Warehouse

# Catalogue label, signal codes and names, weights, bands.
POSITION_CATALOG = "hr_position_catalog"
OVERTIME_CODE = "OVERTIME_HOURS"
OVERTIME_NAME = "Сверхурочная работа"
OVERTIME_GROUP = "WORKLOAD"
INSTABILITY = Scoring(
    value="instability_score",
    level="instability_level_code",
    weights={
        "absence_days_total": "0.20",
        "overtime_hours_total": "0.10",
        "dismissal_signal_cnt": "2.00",
        "active_signal_cnt": "1.50",
    },
    floors=(("12", "HIGH"), ("5", "MEDIUM")),
)

EMPLOYEE = Lookup(
    "hr.dim_hr_employee",
    on={"employee_src_id": "employee_src_id"},
    take={"employee_id": "employee_id"},
    current=True,
)
POSITION = Lookup(
    "hr.dim_position", on={"position_code": "position_code"}, take={"position_id": "position_id"}
)
DEPARTMENT = Lookup(
    "hr.dim_hr_department",
    on={"department_src_id": "department_src_id"},
    take={"department_id": "department_id"},
    current=True,
)


def same(*names: str) -> dict[str, str]:
    """Columns taken over under their own names."""
    return {name: name for name in names}


def yes(*names: str) -> dict[str, str]:
    """Y/N text columns turned into booleans under their own names."""
    return {name: yes_sql(name) for name in names}


LOAD = same("load_dttm", "batch_id")
AUDIT = same("source_system", "load_dttm", "batch_id")


def _departments(wh: Warehouse) -> DataFrame:
    columns = {
        **same("department_src_id", "department_name", "parent_department_src_id", "block_name"),
        **same("function_name", "region_name", "org_level"),
        "manager_employee_src_id": "manager_src_id",
        **same("effective_from", "effective_to"),
        **AUDIT,
    }
    return versioned_dim(wh.raw("hr_department_history_raw"), columns, end="effective_to")


def _department_parents(dim: DataFrame) -> DataFrame:
    return resolve_parent(
        dim,
        key="department_id",
        src="department_src_id",
        parent_src="parent_department_src_id",
        parent_key="parent_department_id",
        current_only=True,
    )


def _positions(wh: Warehouse) -> DataFrame:
    held = {"position_code": "current_position_code", "position_name": "current_position_name"}
    master = project(wh.raw("hr_employee_master_raw"), {**held, **LOAD})
    history = project(
        wh.raw("hr_position_history_raw"), {**same("position_code", "position_name"), **LOAD}
    )
    catalog = catalog_dim([master, history], ["position_code"], POSITION_CATALOG)
    return catalog.withColumn("grade_code", F.lit(None).cast("string"))


def _employees(wh: Warehouse) -> DataFrame:
    columns = {
        **same("employee_src_id", "employee_number", "full_name", "tab_num", "birth_date"),
        **same("gender_code", "employment_status", "hire_date", "dismissal_date"),
        **same("current_position_code", "current_position_name", "department_src_id"),
        "manager_employee_src_id": "manager_src_id",
        **same("grade_code", "work_format", "location_name"),
        "valid_from": "snapshot_date",
        **AUDIT,
    }
    position = Lookup(
        "hr.dim_position",
        on={"current_position_code": "position_code"},
        take={"current_position_id": "position_id"},
    )
    return wh.resolve(
        snapshot_dim(wh.raw("hr_employee_master_raw"), columns), position, DEPARTMENT
    )


def _position_history(wh: Warehouse) -> DataFrame:
    event = Rule(
        "hr_position_history_raw",
        {
            **same("src_position_event_id", "employee_src_id", "position_code", "department_src_id"),
            **same("event_type_code", "event_type_name", "effective_from", "effective_to"),
            **yes("salary_change_flag"),
            **LOAD,
        },
    )
    return wh.resolve(unify([event], wh.raw), EMPLOYEE, POSITION, DEPARTMENT)


def _absences(wh: Warehouse) -> DataFrame:
    event = Rule(
        "hr_absence_events_raw",
        {
            **same("src_absence_event_id", "employee_src_id", "absence_type_code"),
            **same("absence_type_name", "absence_reason_group", "start_date", "end_date"),
            **same("duration_days"),
            **yes("approved_flag"),
            **LOAD,
        },
    )
    return wh.resolve(unify([event], wh.raw), EMPLOYEE)


SIGNALS = (
    Rule(
        "hr_overtime_events_raw",
        {
            "employee_src_id": "employee_src_id",
            "signal_source_type": "'overtime'",
            "source_event_id": "src_overtime_event_id",
            "signal_code": f"'{OVERTIME_CODE}'",
            "signal_name": f"'{OVERTIME_NAME}'",
            "signal_group": f"'{OVERTIME_GROUP}'",
            "signal_value_num": "cast(overtime_hours as decimal(18,4))",
            "signal_value_text": "overtime_reason_name",
            "detected_at": "cast(overtime_date as timestamp_ntz)",
            "signal_status": "if(approved_flag = 'Y', 'APPROVED', 'PENDING')",
            **LOAD,
        },
    ),
    Rule(
        "hr_dismissal_signals_raw",
        {
            "employee_src_id": "employee_src_id",
            "signal_source_type": "'dismissal_signal'",
            "source_event_id": "src_signal_id",
            **same("signal_code", "signal_name", "signal_group", "signal_value_num"),
            **same("signal_value_text", "detected_at", "signal_status"),
            **LOAD,
        },
    ),
)


def _signals(wh: Warehouse) -> DataFrame:
    return wh.resolve(unify(SIGNALS, wh.raw), EMPLOYEE)


ABSENCE_METRICS = {
    "absence_event_cnt": "count(*)",
    "absence_days_total": "sum(duration_days)",
}
SIGNAL_METRICS = {
    "overtime_hours_total": "sum(signal_value_num) filter (where signal_source_type = 'overtime')",
    "dismissal_signal_cnt": "count_if(signal_source_type = 'dismissal_signal')",
    "active_signal_cnt": "count_if(signal_status in ('ACTIVE', 'PENDING'))",
}


def signal_activity(signals: str, metrics: Mapping[str, str], moment: str) -> Callable[[Warehouse], DataFrame]:
    """What one pass over a signal table says of each employee: its metrics and its last signal's time."""
    measures = {**metrics, "last_signal_dttm": f"max({moment})"}
    return lambda wh: wh.measured(signals, "employee_id", measures)


def _snapshot(wh: Warehouse) -> DataFrame:
    employees = wh.table("hr.dim_hr_employee").where("is_current_flag")
    base = project(
        employees,
        {**same("employee_id", "current_position_id"), "current_department_id": "department_id"},
    )
    absences = wh.measured("hr.fct_employee_absence", "employee_id", ABSENCE_METRICS)
    metrics = with_measures(
        base,
        "employee_id",
        [(absences, list(ABSENCE_METRICS)), (wh.activity("hr.agg_employee_signal"), list(SIGNAL_METRICS))],
    )
    return wh.run.stamp(INSTABILITY.apply(metrics), "hr.fct_employee_hr_snapshot")


def people(
    wh: Warehouse, attributes: Sequence[str], position_name: str, department: Mapping[str, str]
) -> DataFrame:
    """Current employees with attributes of their position and department, one row each."""
    keys = {"_position_id": "current_position_id", "_department_id": "department_id"}
    employees = wh.table("hr.dim_hr_employee").where("is_current_flag")
    return wh.resolve(
        project(employees, {**same("employee_id", *attributes), **keys}),
        Lookup(
            "hr.dim_position",
            on={"_position_id": "position_id"},
            take={position_name: "position_name"},
        ),
        Lookup(
            "hr.dim_hr_department",
            on={"_department_id": "department_id"},
            take=department,
            current=True,
        ),
    )


def with_person(facts: DataFrame, profile: DataFrame) -> DataFrame:
    """Facts left-joined to one profile row per employee; the profile's ``employee_id`` is kept."""
    keyed = facts.withColumnRenamed("employee_id", "_employee_id")
    return keyed.join(profile, F.expr("_employee_id = employee_id"), "left")


def with_last_time(wh: Warehouse, snapshot: str, signals: str, dropped: Sequence[str] = ()) -> DataFrame:
    """A snapshot with the time of each employee's latest signal, kept by the pass that counted them."""
    latest = wh.activity(signals, pinned=True).where("employee_id is not null")
    times = latest.select("employee_id", "last_signal_dttm")
    return wh.rows(snapshot).drop(*dropped).join(times, "employee_id", "left")


def control_report(wh: Warehouse, snapshot: str, signals: str, flags: Mapping[str, str]) -> DataFrame:
    """Snapshot with employee attributes, exceedance flags and the last signal time."""
    timed = with_last_time(wh, snapshot, signals)
    profile = people(
        wh,
        ("employee_src_id", "employee_number", "tab_num", "full_name", "employment_status"),
        "position_name",
        same(
            "department_id",
            "department_src_id",
            "department_name",
            "block_name",
            "function_name",
            "region_name",
        ),
    )
    return with_flags(with_person(timed, profile), flags)


def signal_report(wh: Warehouse, signals: DataFrame, snapshot: DataFrame, position_name: str) -> DataFrame:
    """Signals with employee attributes and the report date of the employee's snapshots.

    Profile and report dates are joined first, one row per employee and date. The signals,
    of which one employee may own a large part, then meet them in a single join, where
    adaptive execution is free to split that employee's partition.
    """
    profile = people(
        wh,
        ("employee_src_id", "full_name"),
        position_name,
        same("department_name", "block_name", "function_name", "region_name"),
    )
    dates = snapshot.selectExpr("employee_id as _dated_id", "report_date")
    dated = dates.join(profile, F.expr("_dated_id = employee_id"), "full")
    keyed = dated.selectExpr("coalesce(_dated_id, employee_id) as _person_id", "* except (_dated_id)")
    facts = signals.withColumnRenamed("employee_id", "_employee_id")
    return facts.join(keyed, F.expr("_employee_id = _person_id"), "left")


def _profile_report(wh: Warehouse) -> DataFrame:
    # The position shown is the employee's, not the one noted in the snapshot.
    timed = with_last_time(
        wh, "hr.fct_employee_hr_snapshot", "hr.agg_employee_signal", dropped=["current_position_id"]
    )
    profile = people(
        wh,
        (
            "employee_src_id",
            "employee_number",
            "tab_num",
            "full_name",
            "birth_date",
            "gender_code",
            "employment_status",
            "hire_date",
            "dismissal_date",
            "current_position_id",
            "current_position_code",
            "grade_code",
            "manager_employee_src_id",
            "work_format",
            "location_name",
        ),
        "current_position_name",
        same(
            "department_id",
            "department_src_id",
            "department_name",
            "parent_department_id",
            "block_name",
            "function_name",
            "region_name",
            "org_level",
        ),
    )
    flags = {
        "has_absence_flag": "absence_event_cnt",
        "has_overtime_flag": "overtime_hours_total",
        "has_dismissal_signal_flag": "dismissal_signal_cnt",
    }
    return with_flags(with_person(timed, profile), flags)


def _instability_signals(wh: Warehouse) -> DataFrame:
    return signal_report(
        wh,
        wh.rows("hr.fct_employee_activity_signal"),
        wh.rows("hr.fct_employee_hr_snapshot"),
        "current_position_name",
    )


TABLES = {
    "hr.dim_hr_department": Table(
        _departments,
        "department_id",
        ("department_src_id", "effective_from", "coalesce(effective_to, date'2999-12-31')"),
        _department_parents,
    ),
    # Records without a code share a catalogue row.
    "hr.dim_position": Table(
        _positions, "position_id", ("position_code",), optional=("position_code",)
    ),
    "hr.dim_hr_employee": Table(_employees, "employee_id", ("employee_src_id",)),
    "hr.fct_employee_position_history": Table(
        _position_history,
        "employee_position_history_id",
        ("src_position_event_id", "effective_from"),
        optional=("employee_id",),
    ),
    "hr.fct_employee_absence": Table(
        _absences,
        "employee_absence_id",
        ("src_absence_event_id", "start_date", "duration_days"),
        optional=("employee_id",),
    ),
    "hr.fct_employee_activity_signal": Table(
        _signals,
        "employee_activity_signal_id",
        ("signal_source_type", "source_event_id", "detected_at", "signal_value_num"),
        optional=("employee_id",),
    ),
    "hr.fct_employee_hr_snapshot": Table(_snapshot, "employee_hr_snapshot_id", ("employee_id",)),
}

ACTIVITIES = {
    "hr.agg_employee_signal": signal_activity(
        "hr.fct_employee_activity_signal", SIGNAL_METRICS, "detected_at"
    ),
}

MARTS = {"hr.employee_hr_profile_report": _profile_report}
VIEWS = {"hr.v_employee_instability_signals": _instability_signals}
