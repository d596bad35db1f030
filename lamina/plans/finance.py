"""Finance: cost centres, vendors, expenses, cards, advances, finance signals, finance score."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from lamina.operators.dimensions import catalog_dim, project
from lamina.operators.marts import restrict
from lamina.operators.metrics import with_measures
from lamina.operators.signals import Rule, unify
from lamina.plans.access import code_and_name
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

# Catalogue labels, name prefix, signal codes and names, weights, divisors, bands.
COST_CENTER_CATALOG = "finance_cost_center_catalog"
COST_CENTER_PREFIX = "ЦФО "
VENDOR_CATALOG = "finance_vendor_catalog"
SUSPICIOUS_CARD = ("SUSPICIOUS_CARD_TXN", "Подозрительная карточная операция")
OVERDUE_ADVANCE = ("OVERDUE_ADVANCE_REPORT", "Просроченный авансовый отчёт")
REJECTED_ADVANCE = ("REJECTED_ADVANCE_AMOUNT", "Отклонённая сумма в авансовом отчёте")
MANUAL_PAYROLL = ("MANUAL_PAYROLL_ADJ", "Ручная корректировка начисления")
URGENT_PAYMENT = ("URGENT_VENDOR_PAYMENT", "Срочный платёж поставщику")
SIGNAL_TYPES = ("card_transaction", "advance_report", "payroll_adjustment", "vendor_payment")
FINANCE = Scoring(
    value="finance_risk_score",
    level="finance_risk_level_code",
    weights={
        "suspicious_card_txn_cnt": "2.2",
        "overdue_advance_report_cnt": "1.8",
        "manual_payroll_adj_cnt": "1.3",
        "urgent_vendor_payment_cnt": "1.5",
    },
    divisors={
        "rejected_advance_amount_rub": "50000.0",
        "suspicious_card_amount_rub": "70000.0",
    },
    floors=(("10", "HIGH"), ("4", "MEDIUM")),
)

# Finance keeps only rows of known employees.
KNOWN_EMPLOYEE = replace(EMPLOYEE, orphans="drop")
COST_CENTER = Lookup(
    "finance.dim_finance_cost_center",
    on={"cost_center_code": "cost_center_code"},
    take={"cost_center_id": "cost_center_id"},
)
VENDOR = Lookup(
    "finance.dim_finance_vendor",
    on={"vendor_src_id": "vendor_src_id"},
    take={"finance_vendor_id": "finance_vendor_id"},
)

OVERDUE = "coalesce(overdue_days, 0) > 0"
REJECTED = "coalesce(rejected_amount_rub, 0) > 0"


def _named(pair: tuple[str, str]) -> dict[str, str]:
    return {"signal_code": f"'{pair[0]}'", "signal_name": f"'{pair[1]}'"}


SIGNALS = (
    Rule(
        "finance_corporate_card_txn_raw",
        {
            "employee_src_id": "employee_src_id",
            "signal_source_type": "'card_transaction'",
            "source_event_id": "src_card_txn_id",
            **_named(SUSPICIOUS_CARD),
            "signal_group": "'CARD'",
            "signal_value_num": "cast(amount_rub as decimal(18,4))",
            "signal_value_text": "merchant_name",
            "signal_dttm": "transaction_dttm",
            "signal_status": "'ACTIVE'",
            **LOAD,
        },
        where="suspicious_flag = 'Y'",
    ),
    Rule(
        "finance_advance_report_raw",
        {
            "employee_src_id": "employee_src_id",
            "signal_source_type": "'advance_report'",
            "source_event_id": "src_advance_report_id",
            **code_and_name(OVERDUE, OVERDUE_ADVANCE, REJECTED_ADVANCE),
            "signal_group": "'ADVANCE'",
            "signal_value_num": f"if({OVERDUE}, cast(overdue_days as decimal(18,4)), "
            "cast(rejected_amount_rub as decimal(18,4)))",
            "signal_value_text": "report_status",
            "signal_dttm": "cast(report_period as timestamp_ntz)",
            "signal_status": "report_status",
            **LOAD,
        },
        where=f"{OVERDUE} or {REJECTED}",
    ),
    Rule(
        "finance_payroll_adjustment_raw",
        {
            "employee_src_id": "employee_src_id",
            "signal_source_type": "'payroll_adjustment'",
            "source_event_id": "src_payroll_adj_id",
            **_named(MANUAL_PAYROLL),
            "signal_group": "'PAYROLL'",
            "signal_value_num": "cast(amount_rub as decimal(18,4))",
            "signal_value_text": "adjustment_type_name",
            "signal_dttm": "cast(payroll_month as timestamp_ntz)",
            "signal_status": "if(approved_flag = 'Y', 'APPROVED', 'PENDING')",
            **LOAD,
        },
        where="manual_flag = 'Y'",
    ),
    Rule(
        "finance_vendor_payment_raw",
        {
            "employee_src_id": "employee_src_id",
            "signal_source_type": "'vendor_payment'",
            "source_event_id": "src_vendor_payment_id",
            **_named(URGENT_PAYMENT),
            "signal_group": "'AP'",
            "signal_value_num": "cast(payment_amount_rub as decimal(18,4))",
            "signal_value_text": "vendor_name",
            "signal_dttm": "cast(payment_date as timestamp_ntz)",
            "signal_status": "'ACTIVE'",
            **LOAD,
        },
        where="urgent_flag = 'Y'",
    ),
)


def _cost_centers(wh: Warehouse) -> DataFrame:
    budgets = project(
        wh.raw("finance_budget_limit_raw"), {**same("cost_center_code", "cost_center_name"), **LOAD}
    )
    expenses = project(
        wh.raw("finance_employee_expense_raw").where("cost_center_code is not null"),
        {
            "cost_center_code": "cost_center_code",
            "cost_center_name": f"concat('{COST_CENTER_PREFIX}', cost_center_code)",
            **LOAD,
        },
    )
    return catalog_dim([budgets, expenses], ["cost_center_code"], COST_CENTER_CATALOG)


def _vendors(wh: Warehouse) -> DataFrame:
    payments = project(
        wh.raw("finance_vendor_payment_raw"), {**same("vendor_src_id", "vendor_name"), **LOAD}
    )
    return catalog_dim([payments], ["vendor_src_id"], VENDOR_CATALOG)


def _expenses(wh: Warehouse) -> DataFrame:
    expense = Rule(
        "finance_employee_expense_raw",
        {
            **same("employee_src_id", "cost_center_code", "vendor_src_id"),
            "source_expense_id": "src_expense_id",
            **same("expense_date", "expense_type_code", "expense_type_name", "expense_category"),
            **same("amount_rub", "project_code", "expense_status"),
            **yes("reimbursable_flag"),
            **LOAD,
        },
    )
    return wh.resolve(unify([expense], wh.raw), KNOWN_EMPLOYEE, COST_CENTER, VENDOR)


def _cards(wh: Warehouse) -> DataFrame:
    transaction = Rule(
        "finance_corporate_card_txn_raw",
        {
            "employee_src_id": "employee_src_id",
            "source_card_txn_id": "src_card_txn_id",
            **same("transaction_dttm", "merchant_name", "mcc_code", "transaction_category"),
            **same("amount_rub", "country_name", "city_name"),
            **yes("card_present_flag", "reversal_flag", "suspicious_flag"),
            **LOAD,
        },
    )
    return wh.resolve(unify([transaction], wh.raw), KNOWN_EMPLOYEE)


def _advances(wh: Warehouse) -> DataFrame:
    report = Rule(
        "finance_advance_report_raw",
        {
            "employee_src_id": "employee_src_id",
            "source_advance_report_id": "src_advance_report_id",
            **same("report_period", "total_amount_rub", "approved_amount_rub"),
            **same("rejected_amount_rub", "overdue_days", "report_status"),
            **same("approver_employee_src_id"),
            **LOAD,
        },
    )
    return wh.resolve(unify([report], wh.raw), KNOWN_EMPLOYEE)


def _signals(wh: Warehouse) -> DataFrame:
    return wh.resolve(unify(SIGNALS, wh.raw), KNOWN_EMPLOYEE)


EXPENSE_METRICS = {
    "expense_cnt": "count(*)",
    "expense_amount_total_rub": "cast(sum(amount_rub) as decimal(18,2))",
}
CARD_METRICS = {
    "suspicious_card_txn_cnt": "count_if(suspicious_flag)",
    "suspicious_card_amount_rub": "cast(sum(amount_rub) filter (where suspicious_flag) as decimal(18,2))",
}
ADVANCE_METRICS = {
    "overdue_advance_report_cnt": "count_if(overdue_days > 0)",
    "rejected_advance_amount_rub": "cast(sum(rejected_amount_rub) as decimal(18,2))",
}
SIGNAL_METRICS = {
    "manual_payroll_adj_cnt": f"count_if(signal_code = '{MANUAL_PAYROLL[0]}')",
    "urgent_vendor_payment_cnt": f"count_if(signal_code = '{URGENT_PAYMENT[0]}')",
}


def _snapshot(wh: Warehouse) -> DataFrame:
    employees = wh.table("hr.dim_hr_employee").where("is_current_flag").select("employee_id")
    events = [
        ("finance.fct_employee_expense", EXPENSE_METRICS),
        ("finance.fct_employee_card_transaction", CARD_METRICS),
        ("finance.fct_employee_advance_report", ADVANCE_METRICS),
    ]
    counted = [(wh.measured(t, "employee_id", metrics), list(metrics)) for t, metrics in events]
    signals = (wh.activity("finance.agg_employee_signal"), list(SIGNAL_METRICS))
    metrics = with_measures(employees, "employee_id", [*counted, signals])
    return wh.run.stamp(FINANCE.apply(metrics), "finance.fct_employee_finance_snapshot")


def _control_report(wh: Warehouse) -> DataFrame:
    flags = {
        "has_suspicious_card_flag": "suspicious_card_txn_cnt",
        "has_overdue_advance_flag": "overdue_advance_report_cnt",
        "has_manual_payroll_adj_flag": "manual_payroll_adj_cnt",
        "has_urgent_vendor_payment_flag": "urgent_vendor_payment_cnt",
    }
    return control_report(wh, "finance.fct_employee_finance_snapshot", "finance.agg_employee_signal", flags)


def _suspicious_signals(wh: Warehouse) -> DataFrame:
    return signal_report(
        wh,
        restrict(wh.rows("finance.fct_employee_finance_signal"), "signal_source_type", SIGNAL_TYPES),
        wh.rows("finance.fct_employee_finance_snapshot"),
        "position_name",
    )


TABLES = {
    "finance.dim_finance_cost_center": Table(
        _cost_centers, "cost_center_id", ("cost_center_code",)
    ),
    "finance.dim_finance_vendor": Table(_vendors, "finance_vendor_id", ("vendor_src_id",)),
    "finance.fct_employee_expense": Table(
        _expenses, "employee_expense_id", ("source_expense_id", "expense_date", "amount_rub")
    ),
    "finance.fct_employee_card_transaction": Table(
        _cards, "employee_card_transaction_id", ("source_card_txn_id",)
    ),
    "finance.fct_employee_advance_report": Table(
        _advances, "employee_advance_report_id", ("source_advance_report_id",)
    ),
    "finance.fct_employee_finance_signal": Table(
        _signals,
        "employee_finance_signal_id",
        ("signal_source_type", "source_event_id", "signal_dttm", "signal_value_num"),
    ),
    "finance.fct_employee_finance_snapshot": Table(
        _snapshot, "employee_finance_snapshot_id", ("employee_id",)
    ),
}

ACTIVITIES = {
    "finance.agg_employee_signal": signal_activity("finance.fct_employee_finance_signal", SIGNAL_METRICS, "signal_dttm"),
}

MARTS = {"finance.employee_finance_control_report": _control_report}
VIEWS = {"finance.v_employee_suspicious_expense_signals": _suspicious_signals}
