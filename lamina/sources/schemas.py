"""Column names and types of every stored table.

Fixed values: the layouts users of the warehouse already query, as Spark DDL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

AUDIT = "source_system STRING NOT NULL, load_dttm TIMESTAMP_NTZ NOT NULL, batch_id STRING NOT NULL"

RAW = {
    "hr_employee_master_raw": """
        employee_src_id STRING NOT NULL,
        employee_number STRING,
        full_name STRING NOT NULL,
        tab_num STRING,
        birth_date DATE,
        gender_code STRING,
        employment_status STRING,
        hire_date DATE,
        dismissal_date DATE,
        current_position_code STRING,
        current_position_name STRING,
        department_src_id STRING,
        department_name STRING,
        manager_src_id STRING,
        grade_code STRING,
        work_format STRING,
        location_name STRING,
        snapshot_date DATE NOT NULL
    """,
    "hr_position_history_raw": """
        src_position_event_id STRING NOT NULL,
        employee_src_id STRING NOT NULL,
        position_code STRING NOT NULL,
        position_name STRING NOT NULL,
        department_src_id STRING,
        department_name STRING,
        event_type_code STRING,
        event_type_name STRING,
        grade_code STRING,
        salary_change_flag STRING,
        effective_from DATE NOT NULL,
        effective_to DATE
    """,
    "hr_department_history_raw": """
        src_department_event_id STRING NOT NULL,
        department_src_id STRING NOT NULL,
        department_name STRING NOT NULL,
        parent_department_src_id STRING,
        block_name STRING,
        function_name STRING,
        region_name STRING,
        org_level INT,
        manager_src_id STRING,
        effective_from DATE NOT NULL,
        effective_to DATE
    """,
    "hr_absence_events_raw": """
        src_absence_event_id STRING NOT NULL,
        employee_src_id STRING NOT NULL,
        absence_type_code STRING NOT NULL,
        absence_type_name STRING NOT NULL,
        absence_reason_group STRING,
        start_date DATE NOT NULL,
        end_date DATE,
        duration_days INT,
        approved_flag STRING
    """,
    "hr_overtime_events_raw": """
        src_overtime_event_id STRING NOT NULL,
        employee_src_id STRING NOT NULL,
        overtime_date DATE NOT NULL,
        overtime_hours DECIMAL(10,2) NOT NULL,
        overtime_reason_code STRING,
        overtime_reason_name STRING,
        approved_flag STRING
    """,
    "hr_dismissal_signals_raw": """
        src_signal_id STRING NOT NULL,
        employee_src_id STRING NOT NULL,
        signal_code STRING NOT NULL,
        signal_name STRING NOT NULL,
        signal_group STRING,
        signal_value_num DECIMAL(18,4),
        signal_value_text STRING,
        detected_at TIMESTAMP_NTZ NOT NULL,
        signal_status STRING
    """,
    "risk_ib_incidents_raw": """
        src_incident_id STRING NOT NULL,
        employee_src_id STRING NOT NULL,
        incident_code STRING NOT NULL,
        incident_name STRING NOT NULL,
        severity_level STRING,
        incident_status STRING,
        detected_at TIMESTAMP_NTZ NOT NULL,
        closed_at TIMESTAMP_NTZ,
        channel_name STRING
    """,
    "risk_security_incidents_raw": """
        src_case_id STRING NOT NULL,
        employee_src_id STRING NOT NULL,
        case_type_code STRING NOT NULL,
        case_type_name STRING NOT NULL,
        risk_flag STRING,
        case_status STRING,
        registered_at TIMESTAMP_NTZ NOT NULL,
        resolved_at TIMESTAMP_NTZ,
        resolution_code STRING,
        resolution_name STRING
    """,
    "risk_compliance_incidents_raw": """
        src_violation_id STRING NOT NULL,
        employee_src_id STRING NOT NULL,
        violation_code STRING NOT NULL,
        violation_name STRING NOT NULL,
        control_area STRING,
        materiality_level STRING,
        violation_status STRING,
        detected_at TIMESTAMP_NTZ NOT NULL,
        decision_at TIMESTAMP_NTZ,
        decision_text STRING
    """,
    "risk_nonwork_activity_raw": """
        src_activity_id STRING NOT NULL,
        employee_src_id STRING NOT NULL,
        activity_type_code STRING NOT NULL,
        activity_type_name STRING NOT NULL,
        activity_group STRING,
        activity_status STRING,
        detected_at TIMESTAMP_NTZ NOT NULL,
        valid_from DATE,
        valid_to DATE,
        comment_text STRING
    """,
    "risk_employee_registry_raw": """
        employee_src_id STRING NOT NULL,
        employee_number STRING,
        full_name STRING NOT NULL,
        tab_num STRING,
        position_name STRING,
        department_src_id STRING,
        department_name STRING,
        manager_src_id STRING,
        employment_status STRING,
        hire_date DATE,
        dismissal_date DATE,
        snapshot_date DATE NOT NULL
    """,
    "risk_org_structure_raw": """
        department_src_id STRING NOT NULL,
        department_name STRING NOT NULL,
        parent_department_src_id STRING,
        block_name STRING,
        function_name STRING,
        region_name STRING,
        org_level INT,
        valid_from DATE,
        valid_to DATE,
        snapshot_date DATE NOT NULL
    """,
    "access_system_accounts_raw": """
        src_account_id STRING NOT NULL,
        employee_src_id STRING NOT NULL,
        system_code STRING NOT NULL,
        system_name STRING NOT NULL,
        account_login STRING NOT NULL,
        account_type_code STRING,
        account_type_name STRING,
        privileged_flag STRING,
        admin_flag STRING,
        account_status STRING,
        created_at TIMESTAMP_NTZ,
        disabled_at TIMESTAMP_NTZ
    """,
    "access_role_assignments_raw": """
        src_role_assignment_id STRING NOT NULL,
        employee_src_id STRING NOT NULL,
        src_account_id STRING NOT NULL,
        system_code STRING NOT NULL,
        role_code STRING NOT NULL,
        role_name STRING NOT NULL,
        role_group STRING,
        assigned_at TIMESTAMP_NTZ NOT NULL,
        revoked_at TIMESTAMP_NTZ,
        assignment_status STRING
    """,
    "access_privileged_access_raw": """
        src_priv_event_id STRING NOT NULL,
        employee_src_id STRING NOT NULL,
        src_account_id STRING,
        system_code STRING NOT NULL,
        access_type_code STRING NOT NULL,
        access_type_name STRING NOT NULL,
        request_id STRING,
        approved_flag STRING,
        start_dttm TIMESTAMP_NTZ NOT NULL,
        end_dttm TIMESTAMP_NTZ,
        access_status STRING
    """,
    "access_login_events_raw": """
        src_login_event_id STRING NOT NULL,
        employee_src_id STRING NOT NULL,
        src_account_id STRING,
        system_code STRING NOT NULL,
        login_dttm TIMESTAMP_NTZ NOT NULL,
        login_result STRING,
        auth_method STRING,
        ip_address STRING,
        device_id STRING,
        country_name STRING,
        city_name STRING,
        unusual_geo_flag STRING
    """,
    "access_file_operations_raw": """
        src_file_event_id STRING NOT NULL,
        employee_src_id STRING NOT NULL,
        src_account_id STRING,
        system_code STRING NOT NULL,
        operation_type_code STRING NOT NULL,
        operation_type_name STRING NOT NULL,
        file_classification STRING,
        operation_dttm TIMESTAMP_NTZ NOT NULL,
        object_path STRING,
        download_flag STRING,
        upload_flag STRING,
        external_transfer_flag STRING
    """,
    "access_network_activity_raw": """
        src_network_event_id STRING NOT NULL,
        employee_src_id STRING NOT NULL,
        src_account_id STRING,
        system_code STRING,
        event_dttm TIMESTAMP_NTZ NOT NULL,
        destination_type STRING,
        destination_name STRING,
        traffic_mb DECIMAL(18,4),
        connection_count INT,
        blocked_flag STRING,
        vpn_used_flag STRING
    """,
    "finance_employee_expense_raw": """
        src_expense_id STRING NOT NULL,
        employee_src_id STRING NOT NULL,
        expense_date DATE NOT NULL,
        expense_type_code STRING NOT NULL,
        expense_type_name STRING NOT NULL,
        expense_category STRING,
        amount_rub DECIMAL(18,2) NOT NULL,
        currency_code STRING,
        project_code STRING,
        cost_center_code STRING,
        vendor_src_id STRING,
        expense_status STRING,
        reimbursable_flag STRING
    """,
    "finance_corporate_card_txn_raw": """
        src_card_txn_id STRING NOT NULL,
        employee_src_id STRING NOT NULL,
        transaction_dttm TIMESTAMP_NTZ NOT NULL,
        merchant_name STRING NOT NULL,
        mcc_code STRING,
        transaction_category STRING,
        amount_rub DECIMAL(18,2) NOT NULL,
        currency_code STRING,
        country_name STRING,
        city_name STRING,
        card_present_flag STRING,
        reversal_flag STRING,
        suspicious_flag STRING
    """,
    "finance_advance_report_raw": """
        src_advance_report_id STRING NOT NULL,
        employee_src_id STRING NOT NULL,
        report_period DATE NOT NULL,
        total_amount_rub DECIMAL(18,2) NOT NULL,
        approved_amount_rub DECIMAL(18,2),
        rejected_amount_rub DECIMAL(18,2),
        overdue_days INT,
        report_status STRING,
        approver_employee_src_id STRING
    """,
    "finance_payroll_adjustment_raw": """
        src_payroll_adj_id STRING NOT NULL,
        employee_src_id STRING NOT NULL,
        payroll_month DATE NOT NULL,
        adjustment_type_code STRING NOT NULL,
        adjustment_type_name STRING NOT NULL,
        adjustment_reason_group STRING,
        amount_rub DECIMAL(18,2) NOT NULL,
        manual_flag STRING,
        approved_flag STRING
    """,
    "finance_vendor_payment_raw": """
        src_vendor_payment_id STRING NOT NULL,
        employee_src_id STRING,
        vendor_src_id STRING NOT NULL,
        vendor_name STRING NOT NULL,
        payment_date DATE NOT NULL,
        payment_amount_rub DECIMAL(18,2) NOT NULL,
        payment_type_code STRING,
        payment_type_name STRING,
        contract_code STRING,
        urgent_flag STRING
    """,
    "finance_budget_limit_raw": """
        src_budget_limit_id STRING NOT NULL,
        cost_center_code STRING NOT NULL,
        cost_center_name STRING NOT NULL,
        budget_period DATE NOT NULL,
        budget_amount_rub DECIMAL(18,2) NOT NULL,
        consumed_amount_rub DECIMAL(18,2),
        exceeded_flag STRING
    """,
}

DETAIL = {
    "hr.dim_hr_department": """
        department_id BIGINT NOT NULL,
        department_src_id STRING NOT NULL,
        department_name STRING NOT NULL,
        parent_department_id BIGINT,
        parent_department_src_id STRING,
        block_name STRING,
        function_name STRING,
        region_name STRING,
        org_level INT,
        manager_employee_src_id STRING,
        effective_from DATE,
        effective_to DATE,
        is_current_flag BOOLEAN NOT NULL,
        source_system STRING NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "hr.dim_position": """
        position_id BIGINT NOT NULL,
        position_code STRING NOT NULL,
        position_name STRING NOT NULL,
        grade_code STRING,
        source_system STRING NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "hr.dim_hr_employee": """
        employee_id BIGINT NOT NULL,
        employee_src_id STRING NOT NULL,
        employee_number STRING,
        full_name STRING NOT NULL,
        tab_num STRING,
        birth_date DATE,
        gender_code STRING,
        employment_status STRING,
        hire_date DATE,
        dismissal_date DATE,
        current_position_id BIGINT,
        current_position_code STRING,
        department_id BIGINT,
        department_src_id STRING,
        manager_employee_src_id STRING,
        grade_code STRING,
        work_format STRING,
        location_name STRING,
        valid_from DATE,
        valid_to DATE,
        is_current_flag BOOLEAN NOT NULL,
        source_system STRING NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "hr.fct_employee_position_history": """
        employee_position_history_id BIGINT NOT NULL,
        employee_id BIGINT NOT NULL,
        position_id BIGINT,
        department_id BIGINT,
        event_type_code STRING,
        event_type_name STRING,
        salary_change_flag BOOLEAN,
        effective_from DATE NOT NULL,
        effective_to DATE,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "hr.fct_employee_absence": """
        employee_absence_id BIGINT NOT NULL,
        employee_id BIGINT NOT NULL,
        absence_type_code STRING NOT NULL,
        absence_type_name STRING NOT NULL,
        absence_reason_group STRING,
        start_date DATE NOT NULL,
        end_date DATE,
        duration_days INT,
        approved_flag BOOLEAN,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "hr.fct_employee_activity_signal": """
        employee_activity_signal_id BIGINT NOT NULL,
        employee_id BIGINT NOT NULL,
        signal_source_type STRING NOT NULL,
        source_event_id STRING NOT NULL,
        signal_code STRING NOT NULL,
        signal_name STRING NOT NULL,
        signal_group STRING,
        signal_value_num DECIMAL(18,4),
        signal_value_text STRING,
        detected_at TIMESTAMP_NTZ NOT NULL,
        signal_status STRING,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "hr.fct_employee_hr_snapshot": """
        employee_hr_snapshot_id BIGINT NOT NULL,
        employee_id BIGINT NOT NULL,
        report_date DATE NOT NULL,
        current_position_id BIGINT,
        current_department_id BIGINT,
        absence_event_cnt BIGINT,
        absence_days_total BIGINT,
        overtime_hours_total DECIMAL(18,2),
        dismissal_signal_cnt BIGINT,
        active_signal_cnt BIGINT,
        instability_score DECIMAL(18,4),
        instability_level_code STRING,
        calculation_dttm TIMESTAMP_NTZ NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "risk.dim_department": """
        department_id BIGINT NOT NULL,
        department_src_id STRING NOT NULL,
        department_name STRING NOT NULL,
        parent_department_id BIGINT,
        parent_department_src_id STRING,
        block_name STRING,
        function_name STRING,
        region_name STRING,
        org_level INT,
        valid_from DATE,
        valid_to DATE,
        is_current_flag BOOLEAN NOT NULL,
        source_system STRING NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "risk.dim_employee": """
        employee_id BIGINT NOT NULL,
        employee_src_id STRING NOT NULL,
        employee_number STRING,
        full_name STRING NOT NULL,
        tab_num STRING,
        position_name STRING,
        department_id BIGINT,
        department_src_id STRING,
        manager_employee_src_id STRING,
        employment_status STRING,
        hire_date DATE,
        dismissal_date DATE,
        valid_from DATE,
        valid_to DATE,
        is_current_flag BOOLEAN NOT NULL,
        source_system STRING NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "risk.dim_risk_event_type": """
        risk_event_type_id BIGINT NOT NULL,
        source_system_name STRING NOT NULL,
        source_event_code STRING NOT NULL,
        source_event_name STRING NOT NULL,
        risk_domain STRING NOT NULL,
        event_group_name STRING,
        default_severity_level STRING,
        is_violation_flag BOOLEAN NOT NULL,
        is_behavior_signal_flag BOOLEAN NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "risk.fct_risk_event": """
        risk_event_id BIGINT NOT NULL,
        source_event_id STRING NOT NULL,
        employee_id BIGINT NOT NULL,
        employee_src_id STRING NOT NULL,
        risk_event_type_id BIGINT NOT NULL,
        event_source_system STRING NOT NULL,
        event_status STRING,
        severity_level STRING,
        risk_flag BOOLEAN,
        event_detected_dttm TIMESTAMP_NTZ NOT NULL,
        event_closed_dttm TIMESTAMP_NTZ,
        decision_code STRING,
        decision_text STRING,
        comment_text STRING,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "risk.fct_employee_risk_factor": """
        employee_risk_factor_id BIGINT NOT NULL,
        employee_id BIGINT NOT NULL,
        report_date DATE NOT NULL,
        risk_factor_code STRING NOT NULL,
        risk_factor_name STRING NOT NULL,
        factor_value_num DECIMAL(18,4),
        factor_value_text STRING,
        risk_domain STRING,
        calculation_dttm TIMESTAMP_NTZ NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "risk.fct_employee_risk_snapshot": """
        employee_risk_snapshot_id BIGINT NOT NULL,
        employee_id BIGINT NOT NULL,
        report_date DATE NOT NULL,
        risk_score_value DECIMAL(18,4),
        risk_level_code STRING,
        open_event_cnt BIGINT,
        critical_event_cnt BIGINT,
        ib_event_cnt BIGINT,
        security_event_cnt BIGINT,
        compliance_event_cnt BIGINT,
        nonwork_signal_cnt BIGINT,
        calculation_dttm TIMESTAMP_NTZ NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "access.dim_access_system": """
        access_system_id BIGINT NOT NULL,
        system_code STRING NOT NULL,
        system_name STRING NOT NULL,
        source_system STRING NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "access.dim_access_role": """
        access_role_id BIGINT NOT NULL,
        system_id BIGINT,
        system_code STRING NOT NULL,
        role_code STRING NOT NULL,
        role_name STRING NOT NULL,
        role_group STRING,
        source_system STRING NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "access.fct_employee_account": """
        employee_account_id BIGINT NOT NULL,
        employee_id BIGINT NOT NULL,
        employee_src_id STRING NOT NULL,
        system_id BIGINT,
        system_code STRING NOT NULL,
        source_account_id STRING NOT NULL,
        account_login STRING NOT NULL,
        account_type_code STRING,
        account_type_name STRING,
        privileged_flag BOOLEAN,
        admin_flag BOOLEAN,
        account_status STRING,
        created_at TIMESTAMP_NTZ,
        disabled_at TIMESTAMP_NTZ,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "access.fct_employee_role_assignment": """
        employee_role_assignment_id BIGINT NOT NULL,
        employee_id BIGINT NOT NULL,
        employee_account_id BIGINT,
        access_role_id BIGINT,
        source_role_assignment_id STRING NOT NULL,
        assigned_at TIMESTAMP_NTZ NOT NULL,
        revoked_at TIMESTAMP_NTZ,
        assignment_status STRING,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "access.fct_employee_login_event": """
        employee_login_event_id BIGINT NOT NULL,
        employee_id BIGINT NOT NULL,
        employee_account_id BIGINT,
        system_id BIGINT,
        source_login_event_id STRING NOT NULL,
        login_dttm TIMESTAMP_NTZ NOT NULL,
        login_result STRING,
        auth_method STRING,
        ip_address STRING,
        device_id STRING,
        country_name STRING,
        city_name STRING,
        unusual_geo_flag BOOLEAN,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "access.fct_employee_access_signal": """
        employee_access_signal_id BIGINT NOT NULL,
        employee_id BIGINT NOT NULL,
        signal_source_type STRING NOT NULL,
        source_event_id STRING NOT NULL,
        system_id BIGINT,
        signal_code STRING NOT NULL,
        signal_name STRING NOT NULL,
        signal_group STRING,
        signal_value_num DECIMAL(18,4),
        signal_value_text STRING,
        signal_dttm TIMESTAMP_NTZ NOT NULL,
        signal_status STRING,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "access.fct_employee_access_snapshot": """
        employee_access_snapshot_id BIGINT NOT NULL,
        employee_id BIGINT NOT NULL,
        report_date DATE NOT NULL,
        active_account_cnt BIGINT,
        privileged_account_cnt BIGINT,
        active_role_cnt BIGINT,
        privileged_access_cnt BIGINT,
        failed_login_cnt BIGINT,
        unusual_geo_login_cnt BIGINT,
        external_transfer_cnt BIGINT,
        blocked_network_cnt BIGINT,
        access_risk_score DECIMAL(18,4),
        access_risk_level_code STRING,
        calculation_dttm TIMESTAMP_NTZ NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "finance.dim_finance_cost_center": """
        cost_center_id BIGINT NOT NULL,
        cost_center_code STRING NOT NULL,
        cost_center_name STRING NOT NULL,
        source_system STRING NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "finance.dim_finance_vendor": """
        finance_vendor_id BIGINT NOT NULL,
        vendor_src_id STRING NOT NULL,
        vendor_name STRING NOT NULL,
        source_system STRING NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "finance.fct_employee_expense": """
        employee_expense_id BIGINT NOT NULL,
        employee_id BIGINT NOT NULL,
        employee_src_id STRING NOT NULL,
        cost_center_id BIGINT,
        finance_vendor_id BIGINT,
        source_expense_id STRING NOT NULL,
        expense_date DATE NOT NULL,
        expense_type_code STRING NOT NULL,
        expense_type_name STRING NOT NULL,
        expense_category STRING,
        amount_rub DECIMAL(18,2) NOT NULL,
        project_code STRING,
        expense_status STRING,
        reimbursable_flag BOOLEAN,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "finance.fct_employee_card_transaction": """
        employee_card_transaction_id BIGINT NOT NULL,
        employee_id BIGINT NOT NULL,
        employee_src_id STRING NOT NULL,
        source_card_txn_id STRING NOT NULL,
        transaction_dttm TIMESTAMP_NTZ NOT NULL,
        merchant_name STRING NOT NULL,
        mcc_code STRING,
        transaction_category STRING,
        amount_rub DECIMAL(18,2) NOT NULL,
        country_name STRING,
        city_name STRING,
        card_present_flag BOOLEAN,
        reversal_flag BOOLEAN,
        suspicious_flag BOOLEAN,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "finance.fct_employee_advance_report": """
        employee_advance_report_id BIGINT NOT NULL,
        employee_id BIGINT NOT NULL,
        employee_src_id STRING NOT NULL,
        source_advance_report_id STRING NOT NULL,
        report_period DATE NOT NULL,
        total_amount_rub DECIMAL(18,2) NOT NULL,
        approved_amount_rub DECIMAL(18,2),
        rejected_amount_rub DECIMAL(18,2),
        overdue_days INT,
        report_status STRING,
        approver_employee_src_id STRING,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "finance.fct_employee_finance_signal": """
        employee_finance_signal_id BIGINT NOT NULL,
        employee_id BIGINT NOT NULL,
        signal_source_type STRING NOT NULL,
        source_event_id STRING NOT NULL,
        signal_code STRING NOT NULL,
        signal_name STRING NOT NULL,
        signal_group STRING,
        signal_value_num DECIMAL(18,4),
        signal_value_text STRING,
        signal_dttm TIMESTAMP_NTZ NOT NULL,
        signal_status STRING,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "finance.fct_employee_finance_snapshot": """
        employee_finance_snapshot_id BIGINT NOT NULL,
        employee_id BIGINT NOT NULL,
        report_date DATE NOT NULL,
        expense_cnt BIGINT,
        expense_amount_total_rub DECIMAL(18,2),
        suspicious_card_txn_cnt BIGINT,
        suspicious_card_amount_rub DECIMAL(18,2),
        overdue_advance_report_cnt BIGINT,
        rejected_advance_amount_rub DECIMAL(18,2),
        manual_payroll_adj_cnt BIGINT,
        urgent_vendor_payment_cnt BIGINT,
        finance_risk_score DECIMAL(18,4),
        finance_risk_level_code STRING,
        calculation_dttm TIMESTAMP_NTZ NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
}

_SIGNAL_VIEW = """
        department_name STRING,
        block_name STRING,
        function_name STRING,
        region_name STRING,
        signal_source_type STRING,
        source_event_id STRING,
        signal_code STRING,
        signal_name STRING,
        signal_group STRING,
        signal_value_num DECIMAL(18,4),
        signal_value_text STRING
    """

MARTS = {
    "hr.employee_hr_profile_report": """
        report_date DATE NOT NULL,
        employee_id BIGINT NOT NULL,
        employee_src_id STRING NOT NULL,
        employee_number STRING,
        tab_num STRING,
        full_name STRING NOT NULL,
        birth_date DATE,
        gender_code STRING,
        employment_status STRING,
        hire_date DATE,
        dismissal_date DATE,
        current_position_id BIGINT,
        current_position_code STRING,
        current_position_name STRING,
        grade_code STRING,
        department_id BIGINT,
        department_src_id STRING,
        department_name STRING,
        parent_department_id BIGINT,
        block_name STRING,
        function_name STRING,
        region_name STRING,
        org_level INT,
        manager_employee_src_id STRING,
        work_format STRING,
        location_name STRING,
        absence_event_cnt BIGINT,
        absence_days_total BIGINT,
        overtime_hours_total DECIMAL(18,2),
        dismissal_signal_cnt BIGINT,
        active_signal_cnt BIGINT,
        instability_score DECIMAL(18,4),
        instability_level_code STRING,
        has_absence_flag BOOLEAN,
        has_overtime_flag BOOLEAN,
        has_dismissal_signal_flag BOOLEAN,
        last_signal_dttm TIMESTAMP_NTZ,
        calculation_dttm TIMESTAMP_NTZ NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "risk.employee_operational_risk_report": """
        report_date DATE NOT NULL,
        employee_id BIGINT NOT NULL,
        employee_src_id STRING NOT NULL,
        employee_number STRING,
        tab_num STRING,
        full_name STRING NOT NULL,
        position_name STRING,
        employment_status STRING,
        hire_date DATE,
        dismissal_date DATE,
        department_id BIGINT,
        department_src_id STRING,
        department_name STRING,
        parent_department_id BIGINT,
        parent_department_src_id STRING,
        block_name STRING,
        function_name STRING,
        region_name STRING,
        org_level INT,
        risk_score_value DECIMAL(18,4),
        risk_level_code STRING,
        open_event_cnt BIGINT,
        critical_event_cnt BIGINT,
        ib_event_cnt BIGINT,
        security_event_cnt BIGINT,
        compliance_event_cnt BIGINT,
        nonwork_signal_cnt BIGINT,
        ib_critical_event_cnt BIGINT,
        security_critical_event_cnt BIGINT,
        compliance_critical_event_cnt BIGINT,
        has_open_risk_flag BOOLEAN,
        has_critical_risk_flag BOOLEAN,
        has_nonwork_signal_flag BOOLEAN,
        last_risk_event_dttm TIMESTAMP_NTZ,
        calculation_dttm TIMESTAMP_NTZ NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "access.employee_access_control_report": """
        report_date DATE NOT NULL,
        employee_id BIGINT NOT NULL,
        employee_src_id STRING NOT NULL,
        employee_number STRING,
        tab_num STRING,
        full_name STRING NOT NULL,
        position_name STRING,
        employment_status STRING,
        department_id BIGINT,
        department_src_id STRING,
        department_name STRING,
        block_name STRING,
        function_name STRING,
        region_name STRING,
        active_account_cnt BIGINT,
        privileged_account_cnt BIGINT,
        active_role_cnt BIGINT,
        privileged_access_cnt BIGINT,
        failed_login_cnt BIGINT,
        unusual_geo_login_cnt BIGINT,
        external_transfer_cnt BIGINT,
        blocked_network_cnt BIGINT,
        access_risk_score DECIMAL(18,4),
        access_risk_level_code STRING,
        has_privileged_account_flag BOOLEAN,
        has_unusual_geo_flag BOOLEAN,
        has_external_transfer_flag BOOLEAN,
        has_blocked_network_flag BOOLEAN,
        last_signal_dttm TIMESTAMP_NTZ,
        calculation_dttm TIMESTAMP_NTZ NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
    "finance.employee_finance_control_report": """
        report_date DATE NOT NULL,
        employee_id BIGINT NOT NULL,
        employee_src_id STRING NOT NULL,
        employee_number STRING,
        tab_num STRING,
        full_name STRING NOT NULL,
        position_name STRING,
        employment_status STRING,
        department_id BIGINT,
        department_src_id STRING,
        department_name STRING,
        block_name STRING,
        function_name STRING,
        region_name STRING,
        expense_cnt BIGINT,
        expense_amount_total_rub DECIMAL(18,2),
        suspicious_card_txn_cnt BIGINT,
        suspicious_card_amount_rub DECIMAL(18,2),
        overdue_advance_report_cnt BIGINT,
        rejected_advance_amount_rub DECIMAL(18,2),
        manual_payroll_adj_cnt BIGINT,
        urgent_vendor_payment_cnt BIGINT,
        finance_risk_score DECIMAL(18,4),
        finance_risk_level_code STRING,
        has_suspicious_card_flag BOOLEAN,
        has_overdue_advance_flag BOOLEAN,
        has_manual_payroll_adj_flag BOOLEAN,
        has_urgent_vendor_payment_flag BOOLEAN,
        last_signal_dttm TIMESTAMP_NTZ,
        calculation_dttm TIMESTAMP_NTZ NOT NULL,
        load_dttm TIMESTAMP_NTZ NOT NULL,
        batch_id STRING NOT NULL
    """,
}

VIEWS = {
    "hr.v_employee_instability_signals": f"""
        report_date DATE,
        employee_id BIGINT,
        employee_src_id STRING,
        full_name STRING,
        current_position_name STRING,
        {_SIGNAL_VIEW},
        detected_at TIMESTAMP_NTZ,
        signal_status STRING
    """,
    "risk.v_employee_risk_trend": """
        report_date DATE,
        employee_id BIGINT,
        employee_src_id STRING,
        full_name STRING,
        position_name STRING,
        department_name STRING,
        block_name STRING,
        function_name STRING,
        region_name STRING,
        risk_score_value DECIMAL(18,4),
        risk_level_code STRING,
        open_event_cnt BIGINT,
        critical_event_cnt BIGINT,
        ib_event_cnt BIGINT,
        security_event_cnt BIGINT,
        compliance_event_cnt BIGINT,
        nonwork_signal_cnt BIGINT,
        prev_risk_score_value DECIMAL(18,4),
        risk_score_delta DECIMAL(18,4)
    """,
    "access.v_privileged_access_exceptions": f"""
        report_date DATE,
        employee_id BIGINT,
        employee_src_id STRING,
        full_name STRING,
        position_name STRING,
        {_SIGNAL_VIEW},
        signal_dttm TIMESTAMP_NTZ,
        signal_status STRING
    """,
    "finance.v_employee_suspicious_expense_signals": f"""
        report_date DATE,
        employee_id BIGINT,
        employee_src_id STRING,
        full_name STRING,
        position_name STRING,
        {_SIGNAL_VIEW},
        signal_dttm TIMESTAMP_NTZ,
        signal_status STRING
    """,
}

SUBJECTS = ("hr", "risk", "access", "finance")

@cache
def parse(layout: str) -> T.StructType:
    """StructType of a layout; required columns are the non-nullable ones."""
    return T.StructType.fromDDL(layout)


def raw_schema(table: str) -> T.StructType:
    """Layout of a raw table, audit columns included."""
    return parse(f"{RAW[table]}, {AUDIT}")


def table_schema(table: str) -> T.StructType:
    """Layout of a detail table, mart or view, named ``subject.table``."""
    return parse({**DETAIL, **MARTS, **VIEWS}[table])


def raw_tables(subject: str) -> list[str]:
    """Raw tables of a subject area."""
    return [table for table in RAW if table.startswith(f"{subject}_")]


def required(schema: T.StructType) -> list[str]:
    """Columns that must not be NULL."""
    return [field.name for field in schema if not field.nullable]


def conform(
    df: DataFrame, schema: T.StructType, text: Sequence[str] = (), helpers: Sequence[str] = ()
) -> DataFrame:
    """The schema's columns by name, in its order and types, then ``helpers`` as they are.

    ``text`` columns become strings instead of their declared type.
    """
    types = {f.name: "string" if f.name in text else f.dataType.simpleString() for f in schema}
    casts = [f"cast({name} as {type_}) as {name}" for name, type_ in types.items()]
    return df.selectExpr(*casts, *helpers)
