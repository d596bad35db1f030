"""Risk: departments, employees, event types, events, factors, risk score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions.flags import yes_sql
from lamina.operators.dimensions import catalog_dim, project, resolve_parent, snapshot_dim, versioned_dim
from lamina.operators.marts import trend, with_flags
from lamina.operators.metrics import Factor, activity, factor_lines, factor_measures, factors_wide
from lamina.operators.signals import Rule, unify
from lamina.plans.base import Lookup, Scoring, Table, Warehouse
from lamina.plans.hr import AUDIT, LOAD, same

NO_TEXT = "cast(null as string)"


@dataclass(frozen=True)
class EventSource:
    """A raw table of risk events: its tag, its place in the catalogue, its columns."""

    tag: str
    table: str
    domain: str
    event_id: str
    code: str
    name: str
    status: str
    detected: str
    closed: str
    group: str = "'incident'"
    severity: str = NO_TEXT
    flag: str = "true"
    decision_code: str = NO_TEXT
    decision_text: str = NO_TEXT
    comment: str = NO_TEXT
    behaviour: bool = False

    def event(self) -> Rule:
        return Rule(
            self.table,
            {
                "source_event_id": self.event_id,
                "employee_src_id": "employee_src_id",
                "event_source_system": f"'{self.tag}'",
                "event_status": self.status,
                "severity_level": self.severity,
                "risk_flag": self.flag,
                "event_detected_dttm": self.detected,
                "event_closed_dttm": self.closed,
                "decision_code": self.decision_code,
                "decision_text": self.decision_text,
                "comment_text": self.comment,
                "source_event_code": self.code,
                **LOAD,
            },
        )

    def kind(self, raw: DataFrame) -> DataFrame:
        """The event types of this source; an event is a violation or a behaviour signal."""
        behaviour = str(self.behaviour).lower()
        return project(
            raw,
            {
                "source_system_name": f"'{self.tag}'",
                "source_event_code": self.code,
                "source_event_name": self.name,
                "risk_domain": f"'{self.domain}'",
                "event_group_name": self.group,
                "default_severity_level": self.severity,
                "is_violation_flag": f"not {behaviour}",
                "is_behavior_signal_flag": behaviour,
                **LOAD,
            },
        )


# Event sources, factor codes and names, weights, bands.
EVENT_SOURCES = (
    EventSource(
        tag="ib_incidents",
        table="risk_ib_incidents_raw",
        domain="ib",
        event_id="src_incident_id",
        code="incident_code",
        name="incident_name",
        status="incident_status",
        severity="severity_level",
        detected="detected_at",
        closed="closed_at",
    ),
    EventSource(
        tag="security_cases",
        table="risk_security_incidents_raw",
        domain="security",
        event_id="src_case_id",
        code="case_type_code",
        name="case_type_name",
        status="case_status",
        flag=yes_sql("risk_flag"),
        detected="registered_at",
        closed="resolved_at",
        decision_code="resolution_code",
        decision_text="resolution_name",
    ),
    EventSource(
        tag="compliance_cases",
        table="risk_compliance_incidents_raw",
        domain="compliance",
        event_id="src_violation_id",
        code="violation_code",
        name="violation_name",
        status="violation_status",
        severity="materiality_level",
        detected="detected_at",
        closed="decision_at",
        decision_text="decision_text",
    ),
    EventSource(
        tag="hr_risk_monitor",
        table="risk_nonwork_activity_raw",
        domain="nonwork",
        group="activity_group",
        event_id="src_activity_id",
        code="activity_type_code",
        name="activity_type_name",
        status="activity_status",
        detected="detected_at",
        closed="cast(null as timestamp_ntz)",
        comment="comment_text",
        behaviour=True,
    ),
)
FACTORS = (
    Factor("OPEN_EVENT_CNT", "Количество открытых событий", "all", "event_status = 'OPEN'"),
    Factor("CRITICAL_EVENT_CNT", "Количество критичных событий", "all", "severity_level = 'CRITICAL'"),
    Factor("IB_EVENT_CNT", "Количество ИБ событий", "ib", "event_source_system = 'ib_incidents'"),
    Factor(
        "SECURITY_EVENT_CNT",
        "Количество событий СБ",
        "security",
        "event_source_system = 'security_cases'",
    ),
    Factor(
        "COMPLIANCE_EVENT_CNT",
        "Количество событий комплаенса",
        "compliance",
        "event_source_system = 'compliance_cases'",
    ),
    Factor(
        "NONWORK_SIGNAL_CNT",
        "Количество сигналов нерабочей активности",
        "nonwork",
        "event_source_system = 'hr_risk_monitor'",
    ),
)
RISK = Scoring(
    value="risk_score_value",
    level="risk_level_code",
    weights={
        "open_event_cnt": "1.5",
        "critical_event_cnt": "3",
        "ib_event_cnt": "1",
        "security_event_cnt": "1.2",
        "compliance_event_cnt": "1.1",
        "nonwork_signal_cnt": "1.4",
    },
    floors=(("15", "HIGH"), ("7", "MEDIUM")),
)

DEPARTMENT = Lookup(
    "risk.dim_department",
    on={"department_src_id": "department_src_id"},
    take={"department_id": "department_id"},
    current=True,
)
EMPLOYEE = Lookup(
    "risk.dim_employee",
    on={"employee_src_id": "employee_src_id"},
    take={"employee_id": "employee_id"},
    current=True,
)
EVENT_TYPE = Lookup(
    "risk.dim_risk_event_type",
    on={"event_source_system": "source_system_name", "source_event_code": "source_event_code"},
    take={"risk_event_type_id": "risk_event_type_id"},
)


def _departments(wh: Warehouse) -> DataFrame:
    columns = same(
        "department_src_id",
        "department_name",
        "parent_department_src_id",
        "block_name",
        "function_name",
        "region_name",
        "org_level",
        "valid_from",
        "valid_to",
    )
    return versioned_dim(wh.raw("risk_org_structure_raw"), {**columns, **AUDIT}, end="valid_to")


def _department_parents(dim: DataFrame) -> DataFrame:
    return resolve_parent(
        dim,
        key="department_id",
        src="department_src_id",
        parent_src="parent_department_src_id",
        parent_key="parent_department_id",
        current_only=False,
    )


def _employees(wh: Warehouse) -> DataFrame:
    columns = {
        **same("employee_src_id", "employee_number", "full_name", "tab_num", "position_name"),
        **same("department_src_id", "employment_status", "hire_date", "dismissal_date"),
        "manager_employee_src_id": "manager_src_id",
        "valid_from": "snapshot_date",
        **AUDIT,
    }
    return wh.resolve(snapshot_dim(wh.raw("risk_employee_registry_raw"), columns), DEPARTMENT)


def _event_types(wh: Warehouse) -> DataFrame:
    kinds = [source.kind(wh.raw(source.table)) for source in EVENT_SOURCES]
    return catalog_dim(kinds, [c for c in kinds[0].columns if c not in LOAD])


def _events(wh: Warehouse) -> DataFrame:
    events = unify([source.event() for source in EVENT_SOURCES], wh.raw)
    return wh.resolve(events, EMPLOYEE, EVENT_TYPE)


CRITICAL = {
    f"{column}_critical_event_cnt": f"count_if(event_source_system = '{tag}' and severity_level = 'CRITICAL')"
    for column, tag in {
        "ib": "ib_incidents",
        "security": "security_cases",
        "compliance": "compliance_cases",
    }.items()
}


def _event_activity(wh: Warehouse) -> DataFrame:
    """What one pass over the events says of each employee, for the factors and the report."""
    last = {"last_risk_event_dttm": "max(event_detected_dttm)"}
    measures = {**factor_measures(FACTORS), **CRITICAL, **last}
    return activity(wh.rows("risk.fct_risk_event"), "employee_id", measures)


def _factors(wh: Warehouse) -> DataFrame:
    lines = factor_lines(wh.activity("risk.agg_employee_event"), "employee_id", FACTORS)
    untexted = lines.withColumn("factor_value_text", F.expr(NO_TEXT))
    return wh.run.stamp(untexted, "risk.fct_employee_risk_factor")


def _snapshot(wh: Warehouse) -> DataFrame:
    employees = wh.table("risk.dim_employee").where("is_current_flag").select("employee_id")
    columns = {factor.code: factor.code.lower() for factor in FACTORS}
    factors = wh.rows("risk.fct_employee_risk_factor").where(
        (F.col("report_date") == F.lit(wh.run.report_date).cast("date"))
        & F.col("employee_id").isNotNull()
    )
    wide = factors_wide(factors, "employee_id", columns)
    counts = employees.join(wide, "employee_id", "left").na.fill(0, list(columns.values()))
    return wh.run.stamp(RISK.apply(counts), "risk.fct_employee_risk_snapshot")


def with_employee(
    wh: Warehouse, snapshot: DataFrame, attributes: dict[str, str], department: dict[str, str]
) -> DataFrame:
    """Snapshot with attributes of the risk employee and the employee's current department."""
    return wh.resolve(
        snapshot,
        Lookup(
            "risk.dim_employee",
            on={"employee_id": "employee_id"},
            take={**attributes, "_department_id": "department_id"},
            current=True,
        ),
        Lookup(
            "risk.dim_department",
            on={"_department_id": "department_id"},
            take=department,
            current=True,
        ),
    )


def _operational_report(wh: Warehouse) -> DataFrame:
    events = wh.activity("risk.agg_employee_event", pinned=True).where("employee_id is not null")
    known = events.select("employee_id", "last_risk_event_dttm", *CRITICAL)
    snapshot = wh.rows("risk.fct_employee_risk_snapshot").join(known, "employee_id", "left")
    profile = with_employee(
        wh,
        snapshot.na.fill(0, list(CRITICAL)),
        same(
            "employee_src_id",
            "employee_number",
            "tab_num",
            "full_name",
            "position_name",
            "employment_status",
            "hire_date",
            "dismissal_date",
        ),
        same(
            "department_id",
            "department_src_id",
            "department_name",
            "parent_department_id",
            "parent_department_src_id",
            "block_name",
            "function_name",
            "region_name",
            "org_level",
        ),
    )
    flags = {
        "has_open_risk_flag": "open_event_cnt",
        "has_critical_risk_flag": "critical_event_cnt",
        "has_nonwork_signal_flag": "nonwork_signal_cnt",
    }
    return with_flags(profile, flags)


def _risk_trend(wh: Warehouse) -> DataFrame:
    moved = trend(
        wh.rows("risk.fct_employee_risk_snapshot"),
        "employee_id",
        "report_date",
        "risk_score_value",
        previous="prev_risk_score_value",
        delta="risk_score_delta",
    )
    return with_employee(
        wh,
        moved,
        same("employee_src_id", "full_name", "position_name"),
        same("department_name", "block_name", "function_name", "region_name"),
    )


TABLES = {
    "risk.dim_department": Table(
        _departments, "department_id", ("department_src_id", "valid_from"), _department_parents
    ),
    "risk.dim_employee": Table(_employees, "employee_id", ("employee_src_id",)),
    "risk.dim_risk_event_type": Table(
        _event_types,
        "risk_event_type_id",
        ("source_system_name", "source_event_code", "source_event_name", "default_severity_level"),
    ),
    "risk.fct_risk_event": Table(
        _events,
        "risk_event_id",
        ("event_source_system", "source_event_id", "event_detected_dttm"),
        optional=("employee_id", "risk_event_type_id"),
    ),
    "risk.fct_employee_risk_factor": Table(
        _factors,
        "employee_risk_factor_id",
        ("employee_id", "risk_factor_code"),
        optional=("employee_id",),
    ),
    "risk.fct_employee_risk_snapshot": Table(
        _snapshot, "employee_risk_snapshot_id", ("employee_id",)
    ),
}

ACTIVITIES = {"risk.agg_employee_event": _event_activity}

MARTS = {"risk.employee_operational_risk_report": _operational_report}
VIEWS = {"risk.v_employee_risk_trend": _risk_trend}
