"""The expected tables as DuckDB SQL over the driver's test tables.

Written against the table definitions, not generated from the Spark plans. Each entry is one
common table expression; a query is assembled from the ones it needs.
"""

from __future__ import annotations

import re

from lamina.sources.schemas import DETAIL
from testbed.bindings import BINDINGS, raw_sql

# "key(...)" stands for a dense surrogate key in the given order, NULLs last.
# Quotients are written as exact decimals: DuckDB divides decimals in binary floating point.
CTES: dict[str, str] = {
    # ---- hr
    "hr_dept_rows": """
        select distinct * exclude (src_department_event_id, manager_src_id),
            manager_src_id as manager_employee_src_id, effective_to is null as is_current_flag
        from hr_department_history_raw
    """,
    "hr_dept_keyed": """
        select key(department_src_id, effective_from, ifnull(effective_to, '2999-12-31'::date))
            as department_id, *
        from hr_dept_rows
    """,
    "dim_department_hr": """
        select d.*, (select min(p.department_id) from hr_dept_keyed p
                     where p.is_current_flag and p.department_src_id = d.parent_department_src_id)
            as parent_department_id
        from hr_dept_keyed d
    """,
    "dim_position": """
        with seen as (
            select current_position_code as position_code, current_position_name as position_name,
                load_dttm, batch_id from hr_employee_master_raw
            union all by name
            select position_code, position_name, load_dttm, batch_id from hr_position_history_raw
        )
        select key(position_code) as position_id, position_code, max(position_name) as position_name,
            null::varchar as grade_code, 'hr_position_catalog' as source_system,
            max(load_dttm) as load_dttm, max(batch_id) as batch_id
        from seen group by position_code
    """,
    "dim_employee_hr": """
        with people as (
            select distinct * exclude (department_name) from hr_employee_master_raw
        )
        select key(employee_src_id) as employee_id,
            m.* exclude (current_position_name, manager_src_id, snapshot_date),
            position_id as current_position_id, department_id,
            manager_src_id as manager_employee_src_id, snapshot_date as valid_from,
            null::date as valid_to, true as is_current_flag
        from people m
        left join (select position_id, position_code from dim_position) p
            on p.position_code = m.current_position_code
        left join (select department_id, department_src_id as dsrc from dim_department_hr
                   where is_current_flag) d on d.dsrc = m.department_src_id
    """,
    "who": "select employee_id, employee_src_id from dim_employee_hr where is_current_flag",
    "fct_position_history": """
        select key(src_position_event_id, h.effective_from) as employee_position_history_id,
            who.employee_id, p.position_id, d.department_id,
            h.* exclude (src_position_event_id, employee_src_id, position_code, position_name,
                department_src_id, department_name, grade_code, source_system)
                replace (salary_change_flag is not distinct from 'Y' as salary_change_flag)
        from hr_position_history_raw h
        left join who using (employee_src_id)
        left join dim_position p using (position_code)
        left join (from dim_department_hr where is_current_flag) d using (department_src_id)
    """,
    "fct_absence": """
        select key(src_absence_event_id, start_date, duration_days) as employee_absence_id, who.employee_id,
            a.* exclude (src_absence_event_id, employee_src_id, source_system)
                replace (approved_flag is not distinct from 'Y' as approved_flag)
        from hr_absence_events_raw a left join who using (employee_src_id)
    """,
    "hr_signal_rows": """
        select employee_src_id, 'overtime' as signal_source_type,
            src_overtime_event_id as source_event_id, 'OVERTIME_HOURS' as signal_code,
            'Сверхурочная работа' as signal_name, 'WORKLOAD' as signal_group,
            overtime_hours::decimal(18,4) as signal_value_num,
            overtime_reason_name as signal_value_text, overtime_date::timestamp as detected_at,
            case approved_flag when 'Y' then 'APPROVED' else 'PENDING' end as signal_status,
            load_dttm, batch_id
        from hr_overtime_events_raw
        union all by name
        select * exclude (src_signal_id, source_system), src_signal_id as source_event_id,
            'dismissal_signal' as signal_source_type
        from hr_dismissal_signals_raw
    """,
    "signals_hr": """
        select key(signal_source_type, source_event_id, detected_at, signal_value_num)
                as employee_activity_signal_id,
            who.employee_id, s.* exclude (employee_src_id)
        from hr_signal_rows s left join who using (employee_src_id)
    """,
    "hr_points": """
        with away as (
            select employee_id, count(*) as n, sum(duration_days) as days
            from fct_absence group by employee_id
        ), noted as (
            select employee_id,
                sum(if(signal_source_type = 'overtime', signal_value_num, 0)) as hours,
                count_if(signal_source_type = 'dismissal_signal') as leaving,
                count_if(signal_status = 'ACTIVE' or signal_status = 'PENDING') as live
            from signals_hr group by employee_id
        )
        select employee_id, current_position_id, department_id as current_department_id,
            ifnull(n, 0)::bigint as absence_event_cnt,
            ifnull(days, 0)::bigint as absence_days_total,
            ifnull(hours, 0)::decimal(18,4) as overtime_hours_total,
            ifnull(leaving, 0)::bigint as dismissal_signal_cnt,
            ifnull(live, 0)::bigint as active_signal_cnt
        from (from dim_employee_hr where is_current_flag)
        left join away using (employee_id) left join noted using (employee_id)
    """,
    "snapshot_hr": """
        with scored as (
            select *, 0.20 * absence_days_total + 0.10 * overtime_hours_total
                + 2.00 * dismissal_signal_cnt + 1.50 * active_signal_cnt as points
            from hr_points
        )
        select key(employee_id) as employee_hr_snapshot_id,
            * exclude (points, overtime_hours_total),
            overtime_hours_total::decimal(18,2) as overtime_hours_total,
            '2024-12-31'::date as report_date, points::decimal(18,4) as instability_score,
            case when points >= 12 then 'HIGH' when points >= 5 then 'MEDIUM' else 'LOW' end as instability_level_code,
            '2024-12-31 23:00:00'::timestamp as calculation_dttm,
            '2024-12-31 23:00:00'::timestamp as load_dttm, 'hr_dds_build_001' as batch_id
        from scored
    """,
    "hr_people": """
        select e.*, p.position_name, d.department_name, d.parent_department_id, d.block_name,
            d.function_name, d.region_name, d.org_level, d.department_id as dept_id,
            d.department_src_id as dept_src_id
        from (from dim_employee_hr where is_current_flag) e
        left join dim_position p on p.position_id = e.current_position_id
        left join dim_department_hr d on d.department_id = e.department_id and d.is_current_flag
    """,
    "mart_hr": """
        select s.* exclude (employee_hr_snapshot_id, employee_id, current_position_id,
                current_department_id),
            e.* exclude (department_id, department_src_id, position_name, dept_id, dept_src_id,
                valid_from, valid_to, is_current_flag, source_system, load_dttm, batch_id),
            e.position_name as current_position_name, e.dept_id as department_id,
            e.dept_src_id as department_src_id, s.absence_event_cnt > 0 as has_absence_flag,
            s.overtime_hours_total > 0 as has_overtime_flag,
            s.dismissal_signal_cnt > 0 as has_dismissal_signal_flag,
            (select max(g.detected_at) from signals_hr g where g.employee_id = s.employee_id)
                as last_signal_dttm
        from snapshot_hr s left join hr_people e on e.employee_id = s.employee_id
    """,
    "view_hr_signals": """
        select s.report_date, e.employee_id, e.employee_src_id, e.full_name,
            e.position_name as current_position_name, e.department_name, e.block_name,
            e.function_name, e.region_name, g.* exclude (employee_activity_signal_id, employee_id,
            load_dttm, batch_id)
        from signals_hr g left join hr_people e using (employee_id)
        left join snapshot_hr s using (employee_id)
    """,
    # ---- risk
    "risk_dept_rows": """
        from risk_org_structure_raw
        select distinct * exclude (snapshot_date), valid_to is null as is_current_flag
    """,
    "risk_dept_keyed": """
        select key(department_src_id, valid_from) as department_id, *
        from risk_dept_rows
    """,
    "dim_department_risk": """
        select d.*, (select min(p.department_id) from risk_dept_keyed p
                     where p.department_src_id = d.parent_department_src_id)
            as parent_department_id
        from risk_dept_keyed d
    """,
    "dim_employee_risk": """
        with people as (
            select distinct * exclude (department_name) from risk_employee_registry_raw
        )
        select key(employee_src_id) as employee_id, r.* exclude (manager_src_id, snapshot_date),
            department_id, manager_src_id as manager_employee_src_id,
            snapshot_date as valid_from, null::date as valid_to, true as is_current_flag
        from people r
        left join (select department_id, department_src_id as dsrc from dim_department_risk
                   where is_current_flag) d on d.dsrc = r.department_src_id
    """,
    "risk_rows": """
        select 'ib_incidents' as event_source_system, src_incident_id as source_event_id,
            employee_src_id, incident_code as source_event_code, incident_name as source_event_name,
            'ib' as risk_domain, 'incident' as event_group_name, incident_status as event_status,
            severity_level, true as risk_flag, detected_at as event_detected_dttm,
            closed_at as event_closed_dttm, null::varchar as decision_code,
            null::varchar as decision_text, null::varchar as comment_text, load_dttm, batch_id
        from risk_ib_incidents_raw
        union all by name
        select 'security_cases' as event_source_system, src_case_id as source_event_id,
            employee_src_id, case_type_code as source_event_code,
            case_type_name as source_event_name, 'security' as risk_domain,
            'incident' as event_group_name, case_status as event_status,
            risk_flag is not distinct from 'Y' as risk_flag, registered_at as event_detected_dttm,
            resolved_at as event_closed_dttm, resolution_code as decision_code,
            resolution_name as decision_text, load_dttm, batch_id
        from risk_security_incidents_raw
        union all by name
        select 'compliance_cases' as event_source_system, src_violation_id as source_event_id,
            employee_src_id, violation_code as source_event_code,
            violation_name as source_event_name, 'compliance' as risk_domain,
            'incident' as event_group_name, violation_status as event_status,
            materiality_level as severity_level, true as risk_flag,
            detected_at as event_detected_dttm, decision_at as event_closed_dttm, decision_text,
            load_dttm, batch_id
        from risk_compliance_incidents_raw
        union all by name
        select 'hr_risk_monitor' as event_source_system, src_activity_id as source_event_id,
            employee_src_id, activity_type_code as source_event_code,
            activity_type_name as source_event_name, 'nonwork' as risk_domain,
            activity_group as event_group_name, activity_status as event_status,
            true as risk_flag, detected_at as event_detected_dttm, comment_text,
            load_dttm, batch_id
        from risk_nonwork_activity_raw
    """,
    "risk_types": """
        select event_source_system as source_system_name, source_event_code, source_event_name,
            risk_domain, event_group_name, severity_level as default_severity_level,
            risk_domain <> 'nonwork' as is_violation_flag,
            risk_domain = 'nonwork' as is_behavior_signal_flag,
            max(load_dttm) as load_dttm, max(batch_id) as batch_id
        from risk_rows group by all
    """,
    "dim_risk_event_type": """
        select key(source_system_name, source_event_code, source_event_name,
            default_severity_level) as risk_event_type_id, *
        from risk_types
    """,
    "fct_risk_event": """
        select key(event_source_system, source_event_id, event_detected_dttm) as risk_event_id, e.employee_id,
            t.risk_event_type_id,
            r.* exclude (source_event_code, source_event_name, risk_domain, event_group_name)
        from risk_rows r
        left join (from dim_employee_risk where is_current_flag) e using (employee_src_id)
        left join dim_risk_event_type t on t.source_system_name = r.event_source_system
            and t.source_event_code = r.source_event_code
    """,
    "factors_long": """
        with marked as (
            select employee_id, unnest([
                {'code': 'OPEN_EVENT_CNT', 'label': 'Количество открытых событий', 'dom': 'all',
                 'hit': event_status = 'OPEN'},
                {'code': 'CRITICAL_EVENT_CNT', 'label': 'Количество критичных событий',
                 'dom': 'all', 'hit': severity_level = 'CRITICAL'},
                {'code': 'IB_EVENT_CNT', 'label': 'Количество ИБ событий', 'dom': 'ib',
                 'hit': event_source_system = 'ib_incidents'},
                {'code': 'SECURITY_EVENT_CNT', 'label': 'Количество событий СБ',
                 'dom': 'security', 'hit': event_source_system = 'security_cases'},
                {'code': 'COMPLIANCE_EVENT_CNT', 'label': 'Количество событий комплаенса',
                 'dom': 'compliance', 'hit': event_source_system = 'compliance_cases'},
                {'code': 'NONWORK_SIGNAL_CNT',
                 'label': 'Количество сигналов нерабочей активности', 'dom': 'nonwork',
                 'hit': event_source_system = 'hr_risk_monitor'}]) as f
            from fct_risk_event
        ), counted as (
            select employee_id, f.code as risk_factor_code, f.label as risk_factor_name,
                f.dom as risk_domain, count(*)::decimal(18,4) as factor_value_num
            from marked where f.hit group by all
        )
        select key(employee_id, risk_factor_code) as employee_risk_factor_id, *,
            '2024-12-31'::date as report_date, null::varchar as factor_value_text,
            '2024-12-31 23:00:00'::timestamp as calculation_dttm,
            '2024-12-31 23:00:00'::timestamp as load_dttm, 'risk_dds_build_001' as batch_id
        from counted
    """,
    "risk_points": """
        select employee_id, {factor_columns}
        from (from dim_employee_risk where is_current_flag) e
        left join factors_long f using (employee_id)
        group by employee_id
    """,
    "snapshot_risk": """
        with scored as (
            select *, open_event_cnt * 1.5 + critical_event_cnt * 3 + ib_event_cnt
                + security_event_cnt * 1.2 + compliance_event_cnt * 1.1
                + nonwork_signal_cnt * 1.4 as points
            from risk_points
        )
        select key(employee_id) as employee_risk_snapshot_id, * exclude (points),
            '2024-12-31'::date as report_date, points::decimal(18,4) as risk_score_value,
            case when points >= 15 then 'HIGH' when points >= 7 then 'MEDIUM' else 'LOW' end as risk_level_code,
            '2024-12-31 23:30:00'::timestamp as calculation_dttm,
            '2024-12-31 23:30:00'::timestamp as load_dttm, 'risk_dds_build_001' as batch_id
        from scored
    """,
    "risk_people": """
        select e.* exclude (department_id, department_src_id), d.department_id,
            d.department_src_id, d.department_name, d.parent_department_id,
            d.parent_department_src_id, d.block_name, d.function_name, d.region_name, d.org_level
        from (from dim_employee_risk where is_current_flag) e
        left join dim_department_risk d on d.department_id = e.department_id and d.is_current_flag
    """,
    "mart_risk": """
        with seen as (
            select employee_id, max(event_detected_dttm) as last_risk_event_dttm,
                count_if(event_source_system = 'ib_incidents' and severity_level = 'CRITICAL') as ib,
                count_if(event_source_system = 'security_cases' and severity_level = 'CRITICAL') as sec,
                count_if(event_source_system = 'compliance_cases' and severity_level = 'CRITICAL') as cmp
            from fct_risk_event group by employee_id
        )
        select s.* exclude (employee_risk_snapshot_id),
            p.* exclude (employee_id, manager_employee_src_id, valid_from, valid_to,
                is_current_flag, source_system, load_dttm, batch_id),
            ifnull(ib, 0)::bigint as ib_critical_event_cnt,
            ifnull(sec, 0)::bigint as security_critical_event_cnt,
            ifnull(cmp, 0)::bigint as compliance_critical_event_cnt,
            s.open_event_cnt > 0 as has_open_risk_flag,
            s.critical_event_cnt > 0 as has_critical_risk_flag,
            s.nonwork_signal_cnt > 0 as has_nonwork_signal_flag, last_risk_event_dttm
        from snapshot_risk s left join risk_people p using (employee_id)
        left join seen using (employee_id)
    """,
    "view_risk_trend_one_date": """
        select s.* exclude (employee_risk_snapshot_id, calculation_dttm, load_dttm, batch_id),
            p.employee_src_id, p.full_name, p.position_name, p.department_name, p.block_name,
            p.function_name, p.region_name, null::decimal(18,4) as prev_risk_score_value,
            null::decimal(18,4) as risk_score_delta
        from snapshot_risk s left join risk_people p using (employee_id)
    """,
    # ---- access
    "dim_system": """
        select key(system_code) as access_system_id, system_code, max(system_name) as system_name,
            'access_system_catalog' as source_system, max(load_dttm) as load_dttm,
            max(batch_id) as batch_id
        from access_system_accounts_raw group by system_code
    """,
    "dim_access_role": """
        select key(r.system_code, r.role_code) as access_role_id, s.access_system_id as system_id,
            r.system_code, r.role_code, max(r.role_name) as role_name,
            max(r.role_group) as role_group, 'access_role_catalog' as source_system,
            max(r.load_dttm) as load_dttm, max(r.batch_id) as batch_id
        from access_role_assignments_raw r
        left join dim_system s on s.system_code = r.system_code
        group by s.access_system_id, r.system_code, r.role_code
    """,
    "fct_account": """
        select key(src_account_id) as employee_account_id, who.employee_id,
            s.access_system_id as system_id, src_account_id as source_account_id,
            a.* exclude (src_account_id, system_name, source_system)
                replace (privileged_flag is not distinct from 'Y' as privileged_flag,
                    admin_flag is not distinct from 'Y' as admin_flag)
        from access_system_accounts_raw a left join who on who.employee_src_id = a.employee_src_id
        left join dim_system s on s.system_code = a.system_code
    """,
    "fct_role_assignment": """
        select key(src_role_assignment_id, assigned_at) as employee_role_assignment_id,
            who.employee_id, acc.employee_account_id, role.access_role_id,
            src_role_assignment_id as source_role_assignment_id, assigned_at, revoked_at,
            assignment_status, r.load_dttm, r.batch_id
        from access_role_assignments_raw r
        left join who on who.employee_src_id = r.employee_src_id
        left join fct_account acc on acc.source_account_id = r.src_account_id
            and acc.employee_src_id = r.employee_src_id
        left join dim_access_role role on role.system_code = r.system_code
            and role.role_code = r.role_code
    """,
    "fct_login_event": """
        select key(src_login_event_id, login_dttm) as employee_login_event_id, who.employee_id,
            acc.employee_account_id, s.access_system_id as system_id,
            src_login_event_id as source_login_event_id,
            l.* exclude (src_login_event_id, employee_src_id, src_account_id, system_code,
                source_system)
                replace (unusual_geo_flag is not distinct from 'Y' as unusual_geo_flag)
        from access_login_events_raw l
        left join who on who.employee_src_id = l.employee_src_id
        left join fct_account acc on acc.source_account_id = l.src_account_id
            and acc.employee_src_id = l.employee_src_id
        left join dim_system s on s.system_code = l.system_code
    """,
    "access_signal_rows": """
        select employee_src_id, system_code, 'privileged_access' as signal_source_type,
            src_priv_event_id as source_event_id, access_type_code as signal_code,
            access_type_name as signal_name, 'PRIVILEGED_ACCESS' as signal_group,
            (date_diff('microsecond', start_dttm, end_dttm)::decimal(20,0) / 3600000000)
                ::decimal(18,4) as signal_value_num,
            request_id as signal_value_text, start_dttm as signal_dttm,
            access_status as signal_status, load_dttm, batch_id
        from access_privileged_access_raw
        union all by name
        select employee_src_id, system_code, 'login_event' as signal_source_type,
            src_login_event_id as source_event_id,
            case unusual_geo_flag when 'Y' then 'UNUSUAL_GEO_LOGIN' else 'FAILED_LOGIN' end
                as signal_code,
            case unusual_geo_flag when 'Y' then 'Нетипичная география входа'
                else 'Неуспешный вход' end as signal_name,
            'AUTH' as signal_group, ip_address as signal_value_text, login_dttm as signal_dttm,
            login_result as signal_status, load_dttm, batch_id
        from access_login_events_raw
        where unusual_geo_flag = 'Y' or login_result <> 'SUCCESS'
        union all by name
        select employee_src_id, system_code, 'file_operation' as signal_source_type,
            src_file_event_id as source_event_id,
            case external_transfer_flag when 'Y' then 'EXTERNAL_TRANSFER'
                else 'SENSITIVE_FILE_OP' end as signal_code,
            case external_transfer_flag when 'Y' then 'Внешняя передача файлов'
                else 'Операция с чувствительными файлами' end as signal_name,
            'DATA_ACCESS' as signal_group, object_path as signal_value_text,
            operation_dttm as signal_dttm, 'ACTIVE' as signal_status, load_dttm, batch_id
        from access_file_operations_raw
        where external_transfer_flag = 'Y' or (file_classification in ('CONFIDENTIAL', 'STRICTLY_CONFIDENTIAL')
            and (download_flag = 'Y' or upload_flag = 'Y'))
        union all by name
        select employee_src_id, system_code, 'network_activity' as signal_source_type,
            src_network_event_id as source_event_id,
            case blocked_flag when 'Y' then 'BLOCKED_CONNECTION'
                else 'DIRECT_EXTERNAL_CONNECTION' end as signal_code,
            case blocked_flag when 'Y' then 'Заблокированное сетевое соединение'
                else 'Прямое внешнее соединение без VPN' end as signal_name,
            'NETWORK' as signal_group, traffic_mb as signal_value_num,
            destination_name as signal_value_text, event_dttm as signal_dttm,
            case blocked_flag when 'Y' then 'BLOCKED' else 'ACTIVE' end as signal_status,
            load_dttm, batch_id
        from access_network_activity_raw
        where blocked_flag = 'Y' or (destination_type = 'EXTERNAL'
            and (vpn_used_flag is null or vpn_used_flag = 'N'))
    """,
    "signals_access": """
        select key(signal_source_type, source_event_id, signal_dttm, signal_value_num)
                as employee_access_signal_id,
            who.employee_id, s.access_system_id as system_id,
            r.* exclude (employee_src_id, system_code)
        from access_signal_rows r left join who on who.employee_src_id = r.employee_src_id
        left join dim_system s on s.system_code = r.system_code
    """,
    "login_counts": """
        select employee_id,
            (count(*) filter (login_result <> 'SUCCESS'))::bigint
                as failed_login_cnt,
            count_if(unusual_geo_flag)::bigint as unusual_geo_login_cnt
        from fct_login_event group by employee_id
    """,
    "access_points": """
        with accounts as (
            select employee_id, count_if(account_status = 'ACTIVE') as active_n,
                count_if(account_status = 'ACTIVE' and (privileged_flag or admin_flag)) as priv_n
            from fct_account group by all
        ), roles as (
            select employee_id, count(*) as role_n from fct_role_assignment
            where assignment_status = 'ACTIVE' and revoked_at is null group by all
        ), noted as (
            select employee_id, count_if(signal_source_type = 'privileged_access') as pa_n,
                count_if(signal_code = 'EXTERNAL_TRANSFER') as ext_n,
                count_if(signal_code = 'BLOCKED_CONNECTION') as blk_n
            from signals_access group by all
        )
        select employee_id, ifnull(active_n, 0)::bigint as active_account_cnt,
            ifnull(priv_n, 0)::bigint as privileged_account_cnt,
            ifnull(role_n, 0)::bigint as active_role_cnt,
            ifnull(pa_n, 0)::bigint as privileged_access_cnt,
            ifnull(failed_login_cnt, 0)::bigint as failed_login_cnt,
            ifnull(unusual_geo_login_cnt, 0)::bigint as unusual_geo_login_cnt,
            ifnull(ext_n, 0)::bigint as external_transfer_cnt,
            ifnull(blk_n, 0)::bigint as blocked_network_cnt
        from who left join accounts using (employee_id) left join roles using (employee_id)
        left join login_counts using (employee_id) left join noted using (employee_id)
    """,
    "snapshot_access": """
        with scored as (
            select *, 2.0 * privileged_account_cnt + 2.0 * external_transfer_cnt
                + 2.5 * privileged_access_cnt + 0.2 * failed_login_cnt
                + 1.5 * unusual_geo_login_cnt + 1.2 * blocked_network_cnt as points
            from access_points
        )
        select key(employee_id) as employee_access_snapshot_id, * exclude (points),
            '2024-12-31'::date as report_date, points::decimal(18,4) as access_risk_score,
            case when points >= 12 then 'HIGH' when points >= 5 then 'MEDIUM' else 'LOW' end as access_risk_level_code,
            '2024-12-31 23:10:00'::timestamp as calculation_dttm,
            '2024-12-31 23:10:00'::timestamp as load_dttm, 'access_dds_build_001' as batch_id
        from scored
    """,
    "mart_access": """
        select s.* exclude (employee_access_snapshot_id), {person_columns},
            s.privileged_account_cnt > 0 as has_privileged_account_flag,
            s.unusual_geo_login_cnt > 0 as has_unusual_geo_flag,
            s.external_transfer_cnt > 0 as has_external_transfer_flag,
            s.blocked_network_cnt > 0 as has_blocked_network_flag,
            (select max(g.signal_dttm) from signals_access g where g.employee_id = s.employee_id)
                as last_signal_dttm
        from snapshot_access s left join hr_people e using (employee_id)
    """,
    "view_access_exceptions": """
        select s.report_date, e.employee_id, {signal_person_columns},
            g.* exclude (employee_access_signal_id, employee_id, system_id, load_dttm, batch_id)
        from signals_access g left join hr_people e using (employee_id)
        left join snapshot_access s using (employee_id)
        where signal_source_type in ('privileged_access', 'file_operation', 'network_activity')
    """,
    # ---- finance
    "dim_cost_center": """
        with named as (
            select cost_center_code, cost_center_name, load_dttm, batch_id
            from finance_budget_limit_raw
            union all by name
            select cost_center_code, 'ЦФО ' || cost_center_code as cost_center_name, load_dttm,
                batch_id
            from finance_employee_expense_raw where cost_center_code is not null
        )
        select key(cost_center_code) as cost_center_id, cost_center_code,
            max(cost_center_name) as cost_center_name,
            'finance_cost_center_catalog' as source_system, max(load_dttm) as load_dttm,
            max(batch_id) as batch_id
        from named group by cost_center_code
    """,
    "dim_vendor": """
        select key(vendor_src_id) as finance_vendor_id, vendor_src_id,
            max(vendor_name) as vendor_name, 'finance_vendor_catalog' as source_system,
            max(load_dttm) as load_dttm, max(batch_id) as batch_id
        from finance_vendor_payment_raw group by vendor_src_id
    """,
    "fct_expense": """
        select key(src_expense_id, expense_date, amount_rub) as employee_expense_id,
            who.employee_id, c.cost_center_id, v.finance_vendor_id,
            src_expense_id as source_expense_id,
            x.* exclude (src_expense_id, currency_code, cost_center_code, vendor_src_id,
                source_system)
                replace (reimbursable_flag is not distinct from 'Y' as reimbursable_flag)
        from finance_employee_expense_raw x
        join who on who.employee_src_id = x.employee_src_id
        left join dim_cost_center c on c.cost_center_code = x.cost_center_code
        left join dim_vendor v on v.vendor_src_id = x.vendor_src_id
    """,
    "fct_card": """
        select key(src_card_txn_id) as employee_card_transaction_id, who.employee_id,
            c.employee_src_id, src_card_txn_id as source_card_txn_id,
            c.* exclude (employee_src_id, src_card_txn_id, currency_code, card_present_flag,
                reversal_flag, suspicious_flag, source_system),
            ifnull(card_present_flag = 'Y', false) as card_present_flag,
            ifnull(reversal_flag = 'Y', false) as reversal_flag,
            ifnull(suspicious_flag = 'Y', false) as suspicious_flag
        from finance_corporate_card_txn_raw c join who on who.employee_src_id = c.employee_src_id
    """,
    "fct_advance": """
        select key(src_advance_report_id) as employee_advance_report_id, who.employee_id,
            a.employee_src_id, src_advance_report_id as source_advance_report_id,
            a.* exclude (employee_src_id, src_advance_report_id, source_system)
        from finance_advance_report_raw a join who on who.employee_src_id = a.employee_src_id
    """,
    "finance_signal_rows": """
        select employee_src_id, 'card_transaction' as signal_source_type,
            src_card_txn_id as source_event_id, 'SUSPICIOUS_CARD_TXN' as signal_code,
            'Подозрительная карточная операция' as signal_name, 'CARD' as signal_group,
            amount_rub::decimal(18,4) as signal_value_num, merchant_name as signal_value_text,
            transaction_dttm as signal_dttm, 'ACTIVE' as signal_status, load_dttm, batch_id
        from finance_corporate_card_txn_raw where suspicious_flag = 'Y'
        union all by name
        select employee_src_id, 'advance_report' as signal_source_type,
            src_advance_report_id as source_event_id,
            if(late, 'OVERDUE_ADVANCE_REPORT', 'REJECTED_ADVANCE_AMOUNT') as signal_code,
            if(late, 'Просроченный авансовый отчёт', 'Отклонённая сумма в авансовом отчёте')
                as signal_name,
            'ADVANCE' as signal_group,
            if(late, overdue_days::decimal(18,4), rejected_amount_rub::decimal(18,4))
                as signal_value_num,
            report_status as signal_value_text, report_period::timestamp as signal_dttm,
            report_status as signal_status, load_dttm, batch_id
        from (select *, ifnull(overdue_days > 0, false) as late from finance_advance_report_raw)
        where late or rejected_amount_rub > 0
        union all by name
        select employee_src_id, 'payroll_adjustment' as signal_source_type,
            src_payroll_adj_id as source_event_id, 'MANUAL_PAYROLL_ADJ' as signal_code,
            'Ручная корректировка начисления' as signal_name, 'PAYROLL' as signal_group,
            amount_rub::decimal(18,4) as signal_value_num,
            adjustment_type_name as signal_value_text, payroll_month::timestamp as signal_dttm,
            case approved_flag when 'Y' then 'APPROVED' else 'PENDING' end as signal_status,
            load_dttm, batch_id
        from finance_payroll_adjustment_raw where manual_flag = 'Y'
        union all by name
        select employee_src_id, 'vendor_payment' as signal_source_type,
            src_vendor_payment_id as source_event_id, 'URGENT_VENDOR_PAYMENT' as signal_code,
            'Срочный платёж поставщику' as signal_name, 'AP' as signal_group,
            payment_amount_rub::decimal(18,4) as signal_value_num,
            vendor_name as signal_value_text, payment_date::timestamp as signal_dttm,
            'ACTIVE' as signal_status, load_dttm, batch_id
        from finance_vendor_payment_raw where urgent_flag = 'Y'
    """,
    "signals_finance": """
        select key(signal_source_type, source_event_id, signal_dttm, signal_value_num)
                as employee_finance_signal_id,
            who.employee_id, r.* exclude (employee_src_id)
        from finance_signal_rows r join who on who.employee_src_id = r.employee_src_id
    """,
    "finance_points": """
        with spent as (
            select employee_id, count(*) as n, sum(amount_rub) as total from fct_expense group by 1
        ), carded as (
            select employee_id, count(*) as n, sum(amount_rub) as total
            from fct_card where suspicious_flag group by 1
        ), advanced as (
            select employee_id, count_if(overdue_days > 0) as n, sum(rejected_amount_rub) as total
            from fct_advance group by 1
        ), noted as (
            select employee_id, count_if(signal_code = 'MANUAL_PAYROLL_ADJ') as manual_n,
                count_if(signal_code = 'URGENT_VENDOR_PAYMENT') as urgent_n
            from signals_finance group by 1
        )
        select employee_id, ifnull(spent.n, 0)::bigint as expense_cnt,
            ifnull(spent.total, 0)::decimal(18,2) as expense_amount_total_rub,
            ifnull(carded.n, 0)::bigint as suspicious_card_txn_cnt,
            ifnull(carded.total, 0)::decimal(18,2) as suspicious_card_amount_rub,
            ifnull(advanced.n, 0)::bigint as overdue_advance_report_cnt,
            ifnull(advanced.total, 0)::decimal(18,2) as rejected_advance_amount_rub,
            ifnull(manual_n, 0)::bigint as manual_payroll_adj_cnt,
            ifnull(urgent_n, 0)::bigint as urgent_vendor_payment_cnt
        from who left join spent using (employee_id) left join carded using (employee_id)
        left join advanced using (employee_id) left join noted using (employee_id)
    """,
    "snapshot_finance": """
        with scored as (
            select *, 2.2 * suspicious_card_txn_cnt + 1.8 * overdue_advance_report_cnt
                + 1.3 * manual_payroll_adj_cnt + 1.5 * urgent_vendor_payment_cnt
                -- rejected amount / 50000 and suspicious amount / 70000, in whole numbers
                -- because this engine divides decimals as binary fractions
                + ((rejected_advance_amount_rub * 100)::hugeint * 1000000000000 // 5000000)
                    ::decimal(26,0) * 0.000000000001
                + ((suspicious_card_amount_rub * 100)::hugeint * 1000000000000 // 7000000)
                    ::decimal(26,0) * 0.000000000001 as points
            from finance_points
        )
        select key(employee_id) as employee_finance_snapshot_id, * exclude (points),
            '2024-12-31'::date as report_date, points::decimal(18,4) as finance_risk_score,
            case when points >= 10 then 'HIGH' when points >= 4 then 'MEDIUM' else 'LOW' end as finance_risk_level_code,
            '2024-12-31 23:20:00'::timestamp as calculation_dttm,
            '2024-12-31 23:20:00'::timestamp as load_dttm, 'finance_dds_build_001' as batch_id
        from scored
    """,
    "mart_finance": """
        select s.* exclude (employee_finance_snapshot_id), {person_columns},
            s.suspicious_card_txn_cnt > 0 as has_suspicious_card_flag,
            s.overdue_advance_report_cnt > 0 as has_overdue_advance_flag,
            s.manual_payroll_adj_cnt > 0 as has_manual_payroll_adj_flag,
            s.urgent_vendor_payment_cnt > 0 as has_urgent_vendor_payment_flag,
            (select max(g.signal_dttm) from signals_finance g where g.employee_id = s.employee_id)
                as last_signal_dttm
        from snapshot_finance s left join hr_people e using (employee_id)
    """,
    "view_finance_signals": """
        select s.report_date, e.employee_id, {signal_person_columns},
            g.* exclude (employee_finance_signal_id, employee_id, load_dttm, batch_id)
        from signals_finance g left join hr_people e using (employee_id)
        left join snapshot_finance s using (employee_id)
    """,
}

_PERSON = """e.employee_src_id, e.employee_number, e.tab_num, e.full_name, e.position_name,
            e.employment_status, e.dept_id as department_id, e.dept_src_id as department_src_id,
            e.department_name, e.block_name, e.function_name, e.region_name"""
_SIGNAL_PERSON = """e.employee_src_id, e.full_name, e.position_name, e.department_name,
            e.block_name, e.function_name, e.region_name"""
_FACTOR_COLUMNS = ", ".join(
    f"ifnull(sum(if(risk_factor_code = '{code}', factor_value_num, 0)), 0)::bigint as {code.lower()}"
    for code in (
        "OPEN_EVENT_CNT",
        "CRITICAL_EVENT_CNT",
        "IB_EVENT_CNT",
        "SECURITY_EVENT_CNT",
        "COMPLIANCE_EVENT_CNT",
        "NONWORK_SIGNAL_CNT",
    )
)


def _split(arguments: str) -> list[str]:
    """Arguments of a call, split at its top-level commas."""
    parts, depth = [""], 0
    for char in arguments:
        depth += (char == "(") - (char == ")")
        if char == "," and depth == 0:
            parts.append("")
        else:
            parts[-1] += char
    return [part.strip() for part in parts]


def _expand(text: str) -> str:
    text = text.replace("{person_columns}", _PERSON)
    text = text.replace("{signal_person_columns}", _SIGNAL_PERSON)
    text = text.replace("{factor_columns}", _FACTOR_COLUMNS)
    while (start := re.search(r"\bkey\(", text)) is not None:
        depth, end = 1, start.end()
        while depth:
            depth += (text[end] == "(") - (text[end] == ")")
            end += 1
        order = ", ".join(f"{e} nulls last" for e in _split(text[start.end() : end - 1]))
        text = f"{text[: start.start()]}row_number() over (order by {order}){text[end:]}"
    return text


def with_needed(text: str, extra: dict[str, str] | None = None) -> str:
    """A query preceded by every common table expression it needs, in dependency order."""
    known = {**{table: raw_sql(table) for table in BINDINGS}, **CTES, **(extra or {})}
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in known:
            if name not in ordered and re.search(rf"\b(?:from|join)\s+{name}\b", sql):
                visit(known[name])
                if name not in ordered:
                    ordered.append(name)

    visit(text)
    parts = [f"{name} as ({_expand(known[name])})" for name in ordered]
    return f"with {', '.join([*parts, f'result as ({_expand(text)})'])} select * from result"


def select_all(name: str) -> str:
    """One of the expressions above as a complete query."""
    return with_needed(CTES[name])


def _column_counts(table: str, columns: tuple[str, ...]) -> str:
    return " union all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as null_cnt, "
        f"count(*) = count({c}) as ok from {table}"
        for c in columns
    )


def _row_counts(prefix: str) -> str:
    return " union all ".join(
        f"select '{t}' as table_name, count(*) as src_cnt, count(*) as dst_cnt, true as ok from {t}"
        for t in BINDINGS
        if t.startswith(prefix)
    )


def _range_counts(tables: dict[str, str], changed: str = "false") -> str:
    """Rows per table and thousand record numbers; ranges with a row that ``changed`` holds for differ."""
    return " union all ".join(
        f"select '{t}' as table_name, left({c}, len({c}) - 3) as key_range, count(*) as src_cnt,"
        f" count(*) as dst_cnt, not bool_or({changed if t.startswith('access_login') else 'false'}) as ok"
        f" from {t} group by all"
        for t, c in tables.items()
    )


# Foreign keys and codes that a layout requires and kept records may lack.
OPTIONAL = {
    "dim_position": ["position_code"],
    "fct_position_history": ["employee_id"],
    "fct_absence": ["employee_id"],
    "signals_hr": ["employee_id"],
    "fct_risk_event": ["employee_id", "risk_event_type_id"],
    "factors_long": ["employee_id"],
    "fct_account": ["employee_id"],
    "fct_role_assignment": ["employee_id"],
    "fct_login_event": ["employee_id"],
    "signals_access": ["employee_id"],
}


# The expression above that holds each detail table.
DETAIL_KEYS = {
    "dim_department_hr": "hr.dim_hr_department",
    "dim_position": "hr.dim_position",
    "dim_employee_hr": "hr.dim_hr_employee",
    "fct_position_history": "hr.fct_employee_position_history",
    "fct_absence": "hr.fct_employee_absence",
    "signals_hr": "hr.fct_employee_activity_signal",
    "snapshot_hr": "hr.fct_employee_hr_snapshot",
    "dim_department_risk": "risk.dim_department",
    "dim_employee_risk": "risk.dim_employee",
    "dim_risk_event_type": "risk.dim_risk_event_type",
    "fct_risk_event": "risk.fct_risk_event",
    "factors_long": "risk.fct_employee_risk_factor",
    "snapshot_risk": "risk.fct_employee_risk_snapshot",
    "dim_system": "access.dim_access_system",
    "dim_access_role": "access.dim_access_role",
    "fct_account": "access.fct_employee_account",
    "fct_role_assignment": "access.fct_employee_role_assignment",
    "fct_login_event": "access.fct_employee_login_event",
    "signals_access": "access.fct_employee_access_signal",
    "snapshot_access": "access.fct_employee_access_snapshot",
    "dim_cost_center": "finance.dim_finance_cost_center",
    "dim_vendor": "finance.dim_finance_vendor",
    "fct_expense": "finance.fct_employee_expense",
    "fct_card": "finance.fct_employee_card_transaction",
    "fct_advance": "finance.fct_employee_advance_report",
    "signals_finance": "finance.fct_employee_finance_signal",
    "snapshot_finance": "finance.fct_employee_finance_snapshot",
}


def _required_counts(tables: dict[str, str]) -> str:
    """NULLs in each column that the layout of a detail table requires."""
    parts = []
    for key, name in tables.items():
        columns = re.findall(r"(\w+) [\w(), ]+? NOT NULL", DETAIL[name])
        lines = ", ".join(
            f"{{'c': '{c}', 'o': {str(c in OPTIONAL.get(key, [])).lower()}, 'n': count(*) - count({c})}}"
            for c in columns
        )
        parts.append(f"select '{name}' as table_name, unnest([{lines}]) as l from {key}")
    return (
        "select table_name, l.c as column_name, l.o as is_optional, l.n as null_cnt, l.o or l.n = 0 as ok"
        f" from ({' union all '.join(parts)})"
    )


_TWO_SEVERITIES = {
    "two_severities": """
        select 'ib_incidents' as source_system_name, incident_code as source_event_code,
            if(right(src_incident_id, 1) = '0', 'HIGH', 'LOW') as default_severity_level
        from risk_ib_incidents_raw group by all
    """
}

_BY_WAY_OF_EVENTS = {
    "flag_yn": """
        with t as (
            select event_id, list_extract(['Y', 'N', null, 'y', '', ' Y'], event_id % 6 + 1)
                as flag_text from events
        )
        select *, flag_text is not distinct from 'Y' as flag from t
    """,
    "duration_hours": """
        with t as (
            select event_id, if(event_id % 10 = 0, null, event_id * 104729 % 4000000000) as us
            from events
        )
        select event_id,
            (((us * 10000 + 1800000000) // 3600000000)::decimal(18,0) * 0.0001)::decimal(18,4)
                as exact_hours,
            ((((us // 1000000) * 10000 + 1800) // 3600)::decimal(18,0) * 0.0001)::decimal(18,4)
                as second_hours
        from t
    """,
    "decode_epoch_digits": """
        with t as (select event_id, ts, epoch_us(ts) as us, event_id % 10 as kind from events)
        select event_id,
            case kind when 0 then (us // 1000000)::varchar when 1 then (us // 1000)::varchar
                when 2 then us::varchar
                when 3 then us::varchar || lpad((event_id % 1000)::varchar, 3, '0')
                when 4 then strftime(ts, '%Y-%m-%d %H:%M:%S')
                when 5 then (us // 1000000)::varchar || '7'
                when 6 then '-' || (us // 1000000)::varchar when 7 then 'abc' || event_id::varchar
                when 8 then (us // 86400000000)::varchar end as epoch_text,
            case when kind = 0 or kind = 4 then date_trunc('second', ts)
                when kind = 1 then date_trunc('millisecond', ts) when kind = 2 then ts
                when kind = 3 then ts + to_microseconds(if(event_id % 1000 >= 500, 1, 0)) end
                as decoded
        from t
    """,
    "decode_epoch_date": """
        with t as (select event_id, ts, epoch_us(ts) as us, event_id % 10 as kind from events)
        select event_id,
            case kind when 0 then (us // 1000000)::varchar when 1 then (us // 1000)::varchar
                when 2 then us::varchar
                when 3 then us::varchar || lpad((event_id % 1000)::varchar, 3, '0')
                when 4 then strftime(ts, '%Y-%m-%d')
                when 5 then (us // 86400000000)::varchar || '1'
                when 6 then '-' || (us // 86400000000)::varchar
                when 7 then 'abc' || event_id::varchar
                when 8 then (us // 86400000000)::varchar end as epoch_text,
            case when kind in (0, 1, 2, 3, 4, 8) then ts::date end as decoded
        from t
    """,
    "decode_epoch_range": """
        with t as (select event_id, ts, epoch_us(ts) as us, event_id % 8 as kind from events),
        n as (
            select event_id, ts, us, kind,
                case kind when 0 then us // 1000000 when 1 then us // 1000 when 2 then us
                    when 3 then -(us // 1000000) when 4 then us // 86400000000
                    when 5 then 32503679999 + event_id % 3
                    when 6 then 32503679999999 + event_id % 3 end as epoch_number
            from t
        )
        select event_id, epoch_number,
            case when kind = 0 then date_trunc('second', ts)
                when kind = 1 then date_trunc('millisecond', ts)
                when kind = 4 then '1970-01-01'::timestamp + to_seconds(epoch_number)
                when kind = 5 and event_id % 3 < 2
                    then '3000-01-01'::timestamp - to_seconds(1 - event_id % 3)
                when kind = 5 then '1970-01-01'::timestamp + to_milliseconds(epoch_number)
                when kind = 6 and event_id % 3 < 2
                    then '3000-01-01'::timestamp - to_milliseconds(1 - event_id % 3) end as decoded
        from n
    """,
}

_OTHER = {
    "score_bands": """
        with t as (
            select o_orderkey, ((o_orderkey % 1601) * 1000 - (o_custkey % 2) * 4) as units from orders
        )
        select o_orderkey, (units::decimal(18,0) * 0.00001)::decimal(18,4) as points,
            case when units >= 1200000 then 'HIGH' when units >= 500000 then 'MEDIUM' else 'LOW' end as hr_level,
            case when units >= 1500000 then 'HIGH' when units >= 700000 then 'MEDIUM' else 'LOW' end as risk_level,
            case when units >= 1200000 then 'HIGH' when units >= 500000 then 'MEDIUM' else 'LOW' end as access_level,
            case when units >= 1000000 then 'HIGH' when units >= 400000 then 'MEDIUM' else 'LOW' end as finance_level
        from t
    """,
    "surrogate_key": """
        select key(l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey) as line_id,
            l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey
        from lineitem
    """,
    "surrogate_key_many_slices": """
        select key(l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey) as line_id,
            l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey
        from lineitem
    """,
    "surrogate_key_cast": """
        select key(l_orderkey::varchar, l_linenumber::varchar, l_partkey::varchar, l_suppkey::varchar)
            as line_id, l_orderkey, l_linenumber, l_partkey, l_suppkey
        from lineitem
    """,
    "schema_conform": """
        select * replace (overdue_days::varchar as overdue_days) from finance_advance_report_raw
    """,
    "view_risk_trend": """
        with yearly as (
            select o_custkey as employee_id, date_trunc('year', o_orderdate)::date as report_date,
                sum(o_totalprice::decimal(18,2))::decimal(18,4) as risk_score_value,
                'LOW' as risk_level_code, count_if(o_orderstatus = 'O')::bigint as open_event_cnt,
                count_if(o_orderstatus = 'F')::bigint as critical_event_cnt,
                0::bigint as ib_event_cnt, 0::bigint as security_event_cnt,
                0::bigint as compliance_event_cnt, count(*) as nonwork_signal_cnt
            from orders group by 1, 2
        )
        select y.*, b.risk_score_value as prev_risk_score_value,
            y.risk_score_value - b.risk_score_value as risk_score_delta,
            p.employee_src_id, p.full_name, p.position_name, p.department_name, p.block_name,
            p.function_name, p.region_name
        from yearly y
        asof left join yearly b on b.employee_id = y.employee_id and b.report_date < y.report_date
        left join risk_people p on p.employee_id = y.employee_id
    """,
    "src_csv_roundtrip": "select * from hr_dismissal_signals_raw",
    "src_csv_money": "select * from finance_advance_report_raw",
    "src_parquet_roundtrip": "select * from finance_vendor_payment_raw",
    "src_parquet_epochs": "select * from access_login_events_raw",
    "src_parquet_epoch_range": """
        select * replace (date_trunc('millisecond', detected_at) as detected_at)
        from hr_dismissal_signals_raw
    """,
    "migration_parity": _row_counts("finance_"),
    "migration_parity_hr": _row_counts("hr_"),
    "migration_parity_risk": _row_counts("risk_"),
    "migration_parity_access": _row_counts("access_"),
    "migration_parity_finance": _row_counts("finance_"),
    "migrated_hr": "select * from hr_absence_events_raw",
    "migrated_risk": "select * from risk_security_incidents_raw",
    "migrated_access": "select * from access_file_operations_raw",
    "migrated_finance": "select * from finance_employee_expense_raw",
    "published_mart_risk": "select * from mart_risk",
    "published_mart_access": "select * from mart_access",
    "published_mart_finance": "select * from mart_finance",
    "sql_decode_epoch_ts": _BY_WAY_OF_EVENTS["decode_epoch_digits"],
    "sql_decode_epoch_date": _BY_WAY_OF_EVENTS["decode_epoch_date"],
    "sql_decode_epoch_range": _BY_WAY_OF_EVENTS["decode_epoch_range"],
    "dq_row_parity_lost": """
        select table_name, src_cnt, if(table_name = 'risk_ib_incidents_raw', 0, dst_cnt) as dst_cnt,
            if(table_name = 'risk_ib_incidents_raw', src_cnt = 0, ok) as ok
        from (%s)
    """
    % _row_counts("risk_"),
    "published_mart_hr": "select * from mart_hr",
    "published_mart_hr_bucketed": "select * from mart_hr",
    "src_csv_rejects": """
        with broken as (
            select src_advance_report_id from finance_advance_report_raw
            where src_advance_report_id like '%07'
        )
        select src_advance_report_id, 'loaded' as reason from finance_advance_report_raw
        union all select *, 'overdue_days is no int: n/a' from broken
        union all select *, '13 values instead of 12' from broken
        union all select *, 'overdue_days is no int: ?' from broken
        union all select *, '2 values instead of 12' from broken
    """,
    "dq_content_parity": _range_counts(
        {
            "finance_employee_expense_raw": "src_expense_id",
            "finance_corporate_card_txn_raw": "src_card_txn_id",
            "finance_advance_report_raw": "src_advance_report_id",
            "finance_payroll_adjustment_raw": "src_payroll_adj_id",
            "finance_vendor_payment_raw": "src_vendor_payment_id",
            "finance_budget_limit_raw": "src_budget_limit_id",
        }
    ),
    "dq_content_parity_changed": _range_counts(
        {
            "access_system_accounts_raw": "src_account_id",
            "access_login_events_raw": "src_login_event_id",
        },
        "src_login_event_id like '%0042' or src_login_event_id like '%5042'",
    ),
    "dq_required_detail": _required_counts(DETAIL_KEYS),
    "sink_full_refresh": "select * from fct_position_history",
    "dq_row_parity": _row_counts(""),
    "dq_not_empty": " union all ".join(
        f"select '{table}' as table_name, count(*) > 0 as ok from {table}"
        for table in BINDINGS
        if table.startswith("access_")
    )
    + " union all select 'logins_without_method', count(*) > 0 from access_login_events_raw"
    " where auth_method is null",
    "dq_required": _column_counts(
        "finance_vendor_payment_raw",
        (
            "src_vendor_payment_id",
            "vendor_src_id",
            "vendor_name",
            "payment_date",
            "payment_amount_rub",
            "source_system",
            "load_dttm",
            "batch_id",
            "employee_src_id",
            "urgent_flag",
        ),
    ),
    "dq_unique_key": """
        select source_system_name, source_event_code, count(*) as row_cnt
        from two_severities group by all having count(*) > 1
    """,
    "lookup_cast_key": """
        select o_orderkey, o_orderstatus, employee_account_id, employee_id
        from orders left join fct_account
            on try_cast(split_part(source_account_id, '-', 2) as bigint) = o_orderkey
    """,
    "lookup_fanout": """
        select src_incident_id, incident_code, default_severity_level
        from risk_ib_incidents_raw left join two_severities on source_event_code = incident_code
    """,
}


def oracle_queries(keys: list[str]) -> dict[str, str]:
    """The expected SQL of each query key."""
    special = {**_BY_WAY_OF_EVENTS, **_OTHER}
    return {
        key: with_needed(special[key], _TWO_SEVERITIES) if key in special else select_all(key)
        for key in keys
    }
