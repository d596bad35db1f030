"""Access: systems, roles, accounts, assignments, logins, access signals, access score."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lamina.functions.timing import hours_sql
from lamina.operators.dimensions import catalog_dim, project
from lamina.operators.marts import restrict
from lamina.operators.metrics import with_measures
from lamina.operators.signals import Rule, unify
from lamina.plans.base import Lookup, Scoring, Table, Warehouse
from lamina.plans.hr import (
    EMPLOYEE,
    LOAD,
    control_report,
    same,
    signal_activity,
    signal_report,
    yes,
)

# Catalogue labels, sensitive classes, signal codes and names, weights, bands.
SYSTEM_CATALOG = "access_system_catalog"
ROLE_CATALOG = "access_role_catalog"
SENSITIVE = "('CONFIDENTIAL', 'STRICTLY_CONFIDENTIAL')"
UNUSUAL_GEO = ("UNUSUAL_GEO_LOGIN", "Нетипичная география входа")
FAILED_LOGIN = ("FAILED_LOGIN", "Неуспешный вход")
EXTERNAL_TRANSFER = ("EXTERNAL_TRANSFER", "Внешняя передача файлов")
SENSITIVE_FILE = ("SENSITIVE_FILE_OP", "Операция с чувствительными файлами")
BLOCKED = ("BLOCKED_CONNECTION", "Заблокированное сетевое соединение")
DIRECT = ("DIRECT_EXTERNAL_CONNECTION", "Прямое внешнее соединение без VPN")
EXCEPTIONS = ("privileged_access", "file_operation", "network_activity")
ACCESS = Scoring(
    value="access_risk_score",
    level="access_risk_level_code",
    weights={
        "privileged_account_cnt": "2.0",
        "privileged_access_cnt": "2.5",
        "failed_login_cnt": "0.2",
        "unusual_geo_login_cnt": "1.5",
        "external_transfer_cnt": "2.0",
        "blocked_network_cnt": "1.2",
    },
    floors=(("12", "HIGH"), ("5", "MEDIUM")),
)

SYSTEM = Lookup(
    "access.dim_access_system",
    on={"system_code": "system_code"},
    take={"system_id": "access_system_id"},
)
ACCOUNT = Lookup(
    "access.fct_employee_account",
    on={"src_account_id": "source_account_id", "employee_src_id": "employee_src_id"},
    take={"employee_account_id": "employee_account_id"},
)
ROLE = Lookup(
    "access.dim_access_role",
    on={"system_code": "system_code", "role_code": "role_code"},
    take={"access_role_id": "access_role_id"},
)


def code_and_name(
    condition: str, first: tuple[str, str], second: tuple[str, str]
) -> dict[str, str]:
    """Signal code and name: ``first`` where the condition holds, else ``second``."""
    return {
        "signal_code": f"if({condition}, '{first[0]}', '{second[0]}')",
        "signal_name": f"if({condition}, '{first[1]}', '{second[1]}')",
    }


NO_VALUE = "cast(null as decimal(18,4))"
SIGNAL_KEYS = same("employee_src_id", "system_code")
SIGNALS = (
    Rule(
        "access_privileged_access_raw",
        {
            **SIGNAL_KEYS,
            "signal_source_type": "'privileged_access'",
            "source_event_id": "src_priv_event_id",
            "signal_code": "access_type_code",
            "signal_name": "access_type_name",
            "signal_group": "'PRIVILEGED_ACCESS'",
            "signal_value_num": hours_sql("start_dttm", "end_dttm"),
            "signal_value_text": "request_id",
            "signal_dttm": "start_dttm",
            "signal_status": "access_status",
            **LOAD,
        },
    ),
    Rule(
        "access_login_events_raw",
        {
            **SIGNAL_KEYS,
            "signal_source_type": "'login_event'",
            "source_event_id": "src_login_event_id",
            **code_and_name("unusual_geo_flag = 'Y'", UNUSUAL_GEO, FAILED_LOGIN),
            "signal_group": "'AUTH'",
            "signal_value_num": NO_VALUE,
            "signal_value_text": "ip_address",
            "signal_dttm": "login_dttm",
            "signal_status": "login_result",
            **LOAD,
        },
        where="login_result != 'SUCCESS' or unusual_geo_flag = 'Y'",
    ),
    Rule(
        "access_file_operations_raw",
        {
            **SIGNAL_KEYS,
            "signal_source_type": "'file_operation'",
            "source_event_id": "src_file_event_id",
            **code_and_name("external_transfer_flag = 'Y'", EXTERNAL_TRANSFER, SENSITIVE_FILE),
            "signal_group": "'DATA_ACCESS'",
            "signal_value_num": NO_VALUE,
            "signal_value_text": "object_path",
            "signal_dttm": "operation_dttm",
            "signal_status": "'ACTIVE'",
            **LOAD,
        },
        where=f"external_transfer_flag = 'Y' or (file_classification in {SENSITIVE} "
        "and (download_flag = 'Y' or upload_flag = 'Y'))",
    ),
    Rule(
        "access_network_activity_raw",
        {
            **SIGNAL_KEYS,
            "signal_source_type": "'network_activity'",
            "source_event_id": "src_network_event_id",
            **code_and_name("blocked_flag = 'Y'", BLOCKED, DIRECT),
            "signal_group": "'NETWORK'",
            "signal_value_num": "traffic_mb",
            "signal_value_text": "destination_name",
            "signal_dttm": "event_dttm",
            "signal_status": "if(blocked_flag = 'Y', 'BLOCKED', 'ACTIVE')",
            **LOAD,
        },
        where="blocked_flag = 'Y' or (destination_type = 'EXTERNAL' "
        "and coalesce(vpn_used_flag, 'N') = 'N')",
    ),
)


def _systems(wh: Warehouse) -> DataFrame:
    accounts = project(
        wh.raw("access_system_accounts_raw"), {**same("system_code", "system_name"), **LOAD}
    )
    return catalog_dim([accounts], ["system_code"], SYSTEM_CATALOG)


def _roles(wh: Warehouse) -> DataFrame:
    assignments = project(
        wh.raw("access_role_assignments_raw"),
        {**same("system_code", "role_code", "role_name", "role_group"), **LOAD},
    )
    # The system follows from its code, so the roles are aggregated before the lookup.
    return wh.resolve(
        catalog_dim([assignments], ["system_code", "role_code"], ROLE_CATALOG), SYSTEM
    )


def _accounts(wh: Warehouse) -> DataFrame:
    account = Rule(
        "access_system_accounts_raw",
        {
            **same("employee_src_id", "system_code"),
            "source_account_id": "src_account_id",
            **same("account_login", "account_type_code", "account_type_name", "account_status"),
            **same("created_at", "disabled_at"),
            **yes("privileged_flag", "admin_flag"),
            **LOAD,
        },
    )
    return wh.resolve(unify([account], wh.raw), EMPLOYEE, SYSTEM)


def _role_assignments(wh: Warehouse) -> DataFrame:
    assignment = Rule(
        "access_role_assignments_raw",
        {
            **same("employee_src_id", "src_account_id", "system_code", "role_code"),
            "source_role_assignment_id": "src_role_assignment_id",
            **same("assigned_at", "revoked_at", "assignment_status"),
            **LOAD,
        },
    )
    return wh.resolve(unify([assignment], wh.raw), EMPLOYEE, ACCOUNT, ROLE)


def _logins(wh: Warehouse) -> DataFrame:
    login = Rule(
        "access_login_events_raw",
        {
            **same("employee_src_id", "src_account_id", "system_code"),
            "source_login_event_id": "src_login_event_id",
            **same("login_dttm", "login_result", "auth_method", "ip_address", "device_id"),
            **same("country_name", "city_name"),
            **yes("unusual_geo_flag"),
            **LOAD,
        },
    )
    return wh.resolve(unify([login], wh.raw), EMPLOYEE, ACCOUNT, SYSTEM)


def _signals(wh: Warehouse) -> DataFrame:
    return wh.resolve(unify(SIGNALS, wh.raw), EMPLOYEE, SYSTEM)


ACCOUNT_METRICS = {
    "active_account_cnt": "count_if(account_status = 'ACTIVE')",
    "privileged_account_cnt": "count_if(account_status = 'ACTIVE' and (privileged_flag or admin_flag))",
}
ROLE_METRICS = {"active_role_cnt": "count_if(revoked_at is null and assignment_status = 'ACTIVE')"}
LOGIN_METRICS = {
    "failed_login_cnt": "count_if(login_result != 'SUCCESS')",
    "unusual_geo_login_cnt": "count_if(unusual_geo_flag)",
}
SIGNAL_METRICS = {
    "privileged_access_cnt": "count_if(signal_source_type = 'privileged_access')",
    "external_transfer_cnt": f"count_if(signal_code = '{EXTERNAL_TRANSFER[0]}')",
    "blocked_network_cnt": f"count_if(signal_code = '{BLOCKED[0]}')",
}


def _snapshot(wh: Warehouse) -> DataFrame:
    employees = wh.table("hr.dim_hr_employee").where("is_current_flag").select("employee_id")
    events = [
        ("access.fct_employee_account", ACCOUNT_METRICS),
        ("access.fct_employee_role_assignment", ROLE_METRICS),
        ("access.fct_employee_login_event", LOGIN_METRICS),
    ]
    counted = [(wh.measured(t, "employee_id", metrics), list(metrics)) for t, metrics in events]
    signals = (wh.activity("access.agg_employee_signal"), list(SIGNAL_METRICS))
    metrics = with_measures(employees, "employee_id", [*counted, signals])
    return wh.run.stamp(ACCESS.apply(metrics), "access.fct_employee_access_snapshot")


def _control_report(wh: Warehouse) -> DataFrame:
    flags = {
        "has_privileged_account_flag": "privileged_account_cnt",
        "has_unusual_geo_flag": "unusual_geo_login_cnt",
        "has_external_transfer_flag": "external_transfer_cnt",
        "has_blocked_network_flag": "blocked_network_cnt",
    }
    return control_report(wh, "access.fct_employee_access_snapshot", "access.agg_employee_signal", flags)


def _exceptions(wh: Warehouse) -> DataFrame:
    return signal_report(
        wh,
        restrict(wh.rows("access.fct_employee_access_signal"), "signal_source_type", EXCEPTIONS),
        wh.rows("access.fct_employee_access_snapshot"),
        "position_name",
    )


TABLES = {
    "access.dim_access_system": Table(_systems, "access_system_id", ("system_code",)),
    "access.dim_access_role": Table(_roles, "access_role_id", ("system_code", "role_code")),
    "access.fct_employee_account": Table(
        _accounts, "employee_account_id", ("source_account_id",), optional=("employee_id",)
    ),
    "access.fct_employee_role_assignment": Table(
        _role_assignments,
        "employee_role_assignment_id",
        ("source_role_assignment_id", "assigned_at"),
        optional=("employee_id",),
    ),
    "access.fct_employee_login_event": Table(
        _logins,
        "employee_login_event_id",
        ("source_login_event_id", "login_dttm"),
        optional=("employee_id",),
    ),
    "access.fct_employee_access_signal": Table(
        _signals,
        "employee_access_signal_id",
        ("signal_source_type", "source_event_id", "signal_dttm", "signal_value_num"),
        optional=("employee_id",),
    ),
    "access.fct_employee_access_snapshot": Table(
        _snapshot, "employee_access_snapshot_id", ("employee_id",)
    ),
}

ACTIVITIES = {
    "access.agg_employee_signal": signal_activity("access.fct_employee_access_signal", SIGNAL_METRICS, "signal_dttm"),
}

MARTS = {"access.employee_access_control_report": _control_report}
VIEWS = {"access.v_privileged_access_exceptions": _exceptions}
