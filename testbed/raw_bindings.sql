-- Raw tables of the four subject areas as projections of the driver's test tables.
-- One statement per table, headed by its name; both engines run the same text.

-- hr_employee_master_raw
select 'E'||lpad(cast(c_custkey as string),7,'0') as employee_src_id, 'EMP-'||lpad(cast(c_custkey as string),7,'0') as employee_number,
 c_name as full_name, 'T'||lpad(cast(c_custkey as string),7,'0') as tab_num, date '1975-01-01' + cast(c_custkey % 12000 as int) as birth_date,
 case when c_custkey % 2 = 0 then 'M' else 'F' end as gender_code, case when c_acctbal < 0 then 'DISMISSED' else 'ACTIVE' end as employment_status,
 date '2019-01-01' + cast(c_custkey % 2200 as int) as hire_date, case when c_acctbal < 0 then date '2023-01-01' + cast(c_custkey % 365 as int) end as dismissal_date,
 case when c_custkey % 97 = 0 then null else upper(c_mktsegment) end as current_position_code, c_mktsegment as current_position_name,
 'D'||lpad(cast(c_nationkey as string),4,'0') as department_src_id, 'Department '||cast(c_nationkey as string) as department_name,
 case when c_custkey >= 20 then 'E'||lpad(cast(cast(floor(c_custkey/10) as bigint) as string),7,'0') end as manager_src_id,
 'G'||cast(c_custkey % 5 + 1 as string) as grade_code, case c_custkey % 3 when 0 then 'OFFICE' when 1 then 'HYBRID' else 'REMOTE' end as work_format,
 'Region '||cast(c_nationkey % 5 as string) as location_name, date '2024-12-31' as snapshot_date
from (select * from customer union all select * from customer where c_custkey % 50 = 0) c

-- hr_position_history_raw
select 'POS-'||lpad(cast(o_orderkey as string),9,'0') as src_position_event_id, 'E'||lpad(cast(o_custkey as string),7,'0') as employee_src_id,
 upper(substr(o_orderpriority,3)) as position_code, substr(o_orderpriority,3) as position_name, 'D'||lpad(cast(o_custkey % 25 as string),4,'0') as department_src_id,
 'Department '||cast(o_custkey % 25 as string) as department_name, case o_orderstatus when 'F' then 'PROMOTION' when 'O' then 'MOVE' else 'HIRE' end as event_type_code,
 o_orderstatus as event_type_name, 'G1' as grade_code, case o_orderstatus when 'F' then 'Y' when 'O' then 'N' end as salary_change_flag,
 cast(o_orderdate as date) as effective_from, case when o_orderkey % 3 = 0 then null else cast(o_orderdate as date) + 90 end as effective_to
from orders

-- hr_department_history_raw
select 'DEPT-'||cast(n_nationkey as string)||'-'||cast(v as string) as src_department_event_id, 'D'||lpad(cast(n_nationkey as string),4,'0') as department_src_id,
 case when v = 1 then n_name else n_name||' (arch)' end as department_name, case when n_nationkey >= 5 then 'D'||lpad(cast(n_regionkey as string),4,'0') end as parent_department_src_id,
 r_name as block_name, 'F'||cast(n_nationkey % 4 as string) as function_name, r_name as region_name, case when n_nationkey < 5 then 1 else 2 end as org_level,
 cast(null as string) as manager_src_id, case when v = 1 then date '2024-01-01' else date '2023-01-01' end as effective_from, case when v = 1 then null else date '2023-12-31' end as effective_to
from (select *, 1 as v from nation union all select *, 2 as v from nation where n_nationkey % 4 = 0 union all select *, 3 as v from nation where n_nationkey % 8 = 0) n
 join region on n_regionkey = r_regionkey

-- hr_absence_events_raw
select 'ABS-'||cast(l_orderkey as string)||'-'||cast(l_linenumber as string)||'-'||cast(l_partkey as string)||'-'||cast(l_suppkey as string) as src_absence_event_id,
 case when l_orderkey % 101 = 0 then 'E9999999' else 'E'||lpad(cast(o_custkey as string),7,'0') end as employee_src_id, 'TYPE_'||cast(l_linenumber as string) as absence_type_code,
 'Type '||cast(l_linenumber as string) as absence_type_name, 'G'||cast(l_linenumber % 3 as string) as absence_reason_group, cast(l_shipdate as date) as start_date,
 cast(l_shipdate as date) + cast(l_quantity as int) as end_date, case when l_partkey % 13 = 0 then null else cast(l_quantity as int) end as duration_days,
 case when l_linestatus = 'F' then 'Y' when l_partkey % 7 = 0 then null else 'N' end as approved_flag
from lineitem join orders on l_orderkey = o_orderkey where l_returnflag = 'R'

-- hr_overtime_events_raw
select 'OT-'||lpad(cast(event_id as string),8,'0') as src_overtime_event_id, 'E'||lpad(cast(event_id % (select count(*) from customer) as string),7,'0') as employee_src_id, cast(ts as date) as overtime_date,
 cast(value as decimal(10,2)) as overtime_hours, 'R'||cast(event_id % 4 as string) as overtime_reason_code, 'Reason '||cast(event_id % 4 as string) as overtime_reason_name,
 case when event_id % 11 = 0 then null when event_id % 7 = 0 then 'N' else 'Y' end as approved_flag
from events where event_type = 'click'

-- hr_dismissal_signals_raw
select 'DS-'||lpad(cast(event_id as string),8,'0') as src_signal_id, case when event_id % 53 = 0 then 'E9999999' else 'E'||lpad(cast(event_id % (select count(*) from customer) as string),7,'0') end as employee_src_id,
 'SIG_'||cast(event_id % 5 as string) as signal_code, 'Signal '||cast(event_id % 5 as string) as signal_name, 'G'||cast(event_id % 3 as string) as signal_group,
 cast(value as decimal(18,4)) as signal_value_num, props as signal_value_text, ts as detected_at,
 case when event_id % 17 = 0 then null when event_id % 5 = 3 then 'CLOSED' when event_id % 5 = 4 then 'PENDING' else 'ACTIVE' end as signal_status
from events where event_type = 'error'

-- risk_ib_incidents_raw
select 'IB-'||lpad(cast(event_id as string),8,'0') as src_incident_id, case when event_id % 53 = 0 then 'E9999999' else 'E'||lpad(cast(event_id % (select count(*) from customer) as string),7,'0') end as employee_src_id,
 'IB_'||cast(event_id % 5 as string) as incident_code, 'Incident '||cast(event_id % 5 as string) as incident_name,
 case event_id % 5 when 0 then 'CRITICAL' when 1 then 'HIGH' when 2 then 'MEDIUM' when 3 then 'LOW' end as severity_level, case when event_id % 7 = 0 then 'OPEN' else 'CLOSED' end as incident_status,
 ts as detected_at, case when event_id % 7 = 0 then null else ts + interval '36' hour end as closed_at, 'CH'||cast(event_id % 4 as string) as channel_name
from events where event_type = 'error'

-- risk_security_incidents_raw
select 'SEC-'||lpad(cast(event_id as string),8,'0') as src_case_id, 'E'||lpad(cast(event_id % (select count(*) from customer) as string),7,'0') as employee_src_id, 'SEC_'||cast(event_id % 4 as string) as case_type_code,
 'Case '||cast(event_id % 4 as string) as case_type_name, case when event_id % 19 = 0 then null when event_id % 3 = 0 then 'N' else 'Y' end as risk_flag,
 case when event_id % 4 = 0 then 'OPEN' else 'CLOSED' end as case_status, ts as registered_at, case when event_id % 4 = 0 then null else ts + interval '48' hour end as resolved_at,
 case when event_id % 4 = 0 then null when event_id % 3 = 0 then 'REJECTED' else 'CONFIRMED' end as resolution_code, case when event_id % 4 = 0 then null else 'Resolution' end as resolution_name
from events where event_type = 'view'

-- risk_compliance_incidents_raw
select 'CMP-'||lpad(cast(event_id as string),8,'0') as src_violation_id, 'E'||lpad(cast(event_id % (select count(*) from customer) as string),7,'0') as employee_src_id, 'CMP_'||cast(event_id % 4 as string) as violation_code,
 'Violation '||cast(event_id % 4 as string) as violation_name, 'AREA'||cast(event_id % 4 as string) as control_area,
 case event_id % 4 when 0 then 'CRITICAL' when 1 then 'MEDIUM' when 2 then 'LOW' else 'HIGH' end as materiality_level, case when event_id % 10 < 3 then 'OPEN' else 'CLOSED' end as violation_status,
 ts as detected_at, case when event_id % 10 < 3 then null else ts + interval '72' hour end as decision_at, case when event_id % 10 < 3 then null else 'Decision '||cast(event_id % 3 as string) end as decision_text
from events where event_type = 'purchase'

-- risk_nonwork_activity_raw
select 'NWA-'||lpad(cast(event_id as string),8,'0') as src_activity_id, 'E'||lpad(cast(event_id % (select count(*) from customer) as string),7,'0') as employee_src_id, 'NW_'||cast(event_id % 4 as string) as activity_type_code,
 'Activity '||cast(event_id % 4 as string) as activity_type_name, 'G'||cast(event_id % 4 as string) as activity_group, case when event_id % 4 = 0 then 'CLOSED' else 'ACTIVE' end as activity_status,
 ts as detected_at, cast(ts as date) as valid_from, case when event_id % 4 = 0 then cast(ts as date) + 30 end as valid_to, props as comment_text
from events where event_type = 'signup'

-- risk_employee_registry_raw
select 'E'||lpad(cast(c_custkey as string),7,'0') as employee_src_id, 'EMP-'||lpad(cast(c_custkey as string),7,'0') as employee_number, c_name as full_name,
 'T'||lpad(cast(c_custkey as string),7,'0') as tab_num, c_mktsegment as position_name, 'D'||lpad(cast(c_nationkey as string),4,'0') as department_src_id,
 'Department '||cast(c_nationkey as string) as department_name, case when c_custkey >= 20 then 'E'||lpad(cast(cast(floor(c_custkey/10) as bigint) as string),7,'0') end as manager_src_id,
 case when c_acctbal < 0 then 'DISMISSED' else 'ACTIVE' end as employment_status, date '2019-01-01' + cast(c_custkey % 2200 as int) as hire_date,
 case when c_acctbal < 0 then date '2023-01-01' + cast(c_custkey % 365 as int) end as dismissal_date, date '2024-12-31' as snapshot_date
from (select * from customer union all select * from customer where c_custkey % 50 = 0) c

-- risk_org_structure_raw
select 'D'||lpad(cast(n_nationkey as string),4,'0') as department_src_id, case when v = 1 then n_name else n_name||' (arch)' end as department_name,
 case when n_nationkey >= 5 then 'D'||lpad(cast(n_regionkey + 1 as string),4,'0') end as parent_department_src_id, r_name as block_name, 'F'||cast(n_nationkey % 4 as string) as function_name,
 r_name as region_name, case when n_nationkey < 5 then 1 else 2 end as org_level, case when v = 1 then date '2024-01-01' else date '2023-01-01' end as valid_from,
 case when v = 1 then null else date '2023-12-31' end as valid_to, date '2024-12-31' as snapshot_date
from (select *, 1 as v from nation union all select *, 2 as v from nation where n_nationkey % 4 = 0) n join region on n_regionkey = r_regionkey

-- access_system_accounts_raw
select 'ACC-'||lpad(cast(o_orderkey as string),9,'0') as src_account_id, 'E'||lpad(cast(o_custkey as string),7,'0') as employee_src_id, 'S'||substr(o_orderpriority,1,1) as system_code,
 'System '||substr(o_orderpriority,1,1) as system_name, 'login_'||cast(o_orderkey as string) as account_login, 'T'||substr(o_orderpriority,1,1) as account_type_code, o_orderpriority as account_type_name,
 case o_orderstatus when 'F' then 'Y' when 'O' then 'N' end as privileged_flag, case when o_orderkey % 10 = 0 then 'Y' else 'N' end as admin_flag,
 case when o_orderkey % 25 = 0 then 'DISABLED' else 'ACTIVE' end as account_status, o_orderdate as created_at, case when o_orderkey % 25 = 0 then o_orderdate + interval '240' hour end as disabled_at
from orders

-- access_role_assignments_raw
select 'ROLE-'||cast(l_orderkey as string)||'-'||cast(l_linenumber as string)||'-'||cast(l_partkey as string)||'-'||cast(l_suppkey as string) as src_role_assignment_id,
 'E'||lpad(cast(o_custkey as string),7,'0') as employee_src_id, 'ACC-'||lpad(cast(l_orderkey as string),9,'0') as src_account_id, 'S'||substr(o_orderpriority,1,1) as system_code,
 'R_'||l_returnflag||l_linestatus as role_code, 'Role '||l_returnflag||l_linestatus as role_name, case l_returnflag when 'A' then 'PRIVILEGED' when 'N' then 'BASE' end as role_group,
 l_shipdate as assigned_at, case when l_partkey % 12 = 0 then l_shipdate + interval '720' hour end as revoked_at, case when l_partkey % 12 = 0 then 'REVOKED' else 'ACTIVE' end as assignment_status
from lineitem join orders on l_orderkey = o_orderkey

-- access_privileged_access_raw
select 'PRIV-'||cast(l_orderkey as string)||'-'||cast(l_linenumber as string)||'-'||cast(l_partkey as string)||'-'||cast(l_suppkey as string) as src_priv_event_id,
 'E'||lpad(cast(o_custkey as string),7,'0') as employee_src_id, 'ACC-'||lpad(cast(l_orderkey as string),9,'0') as src_account_id, 'S'||substr(o_orderpriority,1,1) as system_code,
 'PA_'||cast(l_linenumber % 3 as string) as access_type_code, 'Access '||cast(l_linenumber % 3 as string) as access_type_name, 'REQ-'||cast(l_partkey as string) as request_id,
 case when l_partkey % 8 = 0 then 'N' else 'Y' end as approved_flag, l_shipdate as start_dttm,
 case l_linenumber % 3 when 0 then null when 1 then l_shipdate + interval '90' minute else l_shipdate + interval '500' second end as end_dttm, case when l_partkey % 5 = 0 then 'ACTIVE' else 'CLOSED' end as access_status
from lineitem join orders on l_orderkey = o_orderkey

-- access_login_events_raw
select 'LOGIN-'||lpad(cast(event_id as string),8,'0') as src_login_event_id, case when event_id % 53 = 0 then 'E9999999' else 'E'||lpad(cast(o_custkey as string),7,'0') end as employee_src_id,
 'ACC-'||lpad(cast(o_orderkey as string),9,'0') as src_account_id, 'S'||cast(event_id % 6 + 1 as string) as system_code, ts as login_dttm,
 case when event_id % 37 = 0 then null when event_id % 12 = 0 then 'FAILED' else 'SUCCESS' end as login_result, 'SSO' as auth_method, '10.0.0.'||cast(event_id % 250 as string) as ip_address,
 'DEV-'||cast(event_id % 100 as string) as device_id, 'C'||cast(event_id % 6 as string) as country_name, 'City'||cast(event_id % 6 as string) as city_name,
 case when event_id % 41 = 0 then null when event_id % 9 = 0 then 'Y' else 'N' end as unusual_geo_flag
from (select *, event_id % (select count(*) from orders) as account from events where event_type in ('click','error')) e left join orders on account = o_orderkey

-- access_file_operations_raw
select 'FILE-'||lpad(cast(event_id as string),8,'0') as src_file_event_id, 'E'||lpad(cast(event_id % (select count(*) from customer) as string),7,'0') as employee_src_id, cast(null as string) as src_account_id,
 'S'||cast(event_id % 5 + 1 as string) as system_code, case event_id % 3 when 0 then 'READ' when 1 then 'DOWNLOAD' else 'UPLOAD' end as operation_type_code, 'Op '||cast(event_id % 3 as string) as operation_type_name,
 case event_id % 5 when 0 then 'PUBLIC' when 1 then 'INTERNAL' when 2 then 'CONFIDENTIAL' when 3 then 'STRICTLY_CONFIDENTIAL' end as file_classification, ts as operation_dttm,
 '/data/'||cast(event_id as string)||'.dat' as object_path, case when event_id % 3 = 1 then 'Y' else 'N' end as download_flag, case when event_id % 3 = 2 then 'Y' else 'N' end as upload_flag,
 case when event_id % 23 = 0 then null when event_id % 12 = 0 then 'Y' else 'N' end as external_transfer_flag
from events where event_type = 'view'

-- access_network_activity_raw
select 'NET-'||lpad(cast(event_id as string),8,'0') as src_network_event_id, 'E'||lpad(cast(event_id % (select count(*) from customer) as string),7,'0') as employee_src_id, cast(null as string) as src_account_id,
 case when event_id % 8 = 0 then null else 'S'||cast(event_id % 5 + 1 as string) end as system_code, ts as event_dttm, case when event_id % 3 = 0 then 'INTERNAL' else 'EXTERNAL' end as destination_type,
 'host'||cast(event_id % 6 as string) as destination_name, cast(value as decimal(18,4)) as traffic_mb, cast(event_id % 20 as int) as connection_count,
 case when event_id % 29 = 0 then null when event_id % 16 = 0 then 'Y' else 'N' end as blocked_flag, case when event_id % 7 = 0 then null when event_id % 9 = 0 then 'N' else 'Y' end as vpn_used_flag
from events where event_type = 'purchase'

-- finance_employee_expense_raw
select 'EXP-'||cast(l_orderkey as string)||'-'||cast(l_linenumber as string)||'-'||cast(l_partkey as string)||'-'||cast(l_suppkey as string) as src_expense_id,
 case when l_orderkey % 101 = 0 then 'E9999999' else 'E'||lpad(cast(o_custkey as string),7,'0') end as employee_src_id, cast(l_shipdate as date) as expense_date, 'X'||cast(l_linenumber as string) as expense_type_code,
 'Expense '||cast(l_linenumber as string) as expense_type_name, l_linestatus as expense_category, cast(l_extendedprice as decimal(18,2)) as amount_rub, 'RUB' as currency_code, 'PRJ-'||cast(l_partkey % 120 as string) as project_code,
 case when l_partkey % 29 = 0 then null else 'CC_D'||lpad(cast(o_custkey % 30 as string),4,'0') end as cost_center_code, 'V'||lpad(cast(l_suppkey as string),5,'0') as vendor_src_id,
 case when l_partkey % 4 = 0 then 'PENDING' else 'APPROVED' end as expense_status, case when l_partkey % 5 = 0 then 'N' when l_partkey % 11 = 0 then null else 'Y' end as reimbursable_flag
from lineitem join orders on l_orderkey = o_orderkey where l_returnflag = 'A'

-- finance_corporate_card_txn_raw
select 'CARD-'||lpad(cast(event_id as string),8,'0') as src_card_txn_id, case when event_id % 53 = 0 then 'E9999999' else 'E'||lpad(cast(event_id % (select count(*) from customer) as string),7,'0') end as employee_src_id, ts as transaction_dttm,
 'Merchant '||cast(event_id % 8 as string) as merchant_name, '45'||cast(event_id % 90 as string) as mcc_code, 'CAT'||cast(event_id % 6 as string) as transaction_category,
 cast(cast(value as decimal(18,2)) * 100 as decimal(18,2)) as amount_rub, 'RUB' as currency_code, 'C'||cast(event_id % 6 as string) as country_name, 'City'||cast(event_id % 6 as string) as city_name,
 case when event_id % 2 = 0 then 'Y' else 'N' end as card_present_flag, case when event_id % 33 = 0 then 'Y' else 'N' end as reversal_flag, case when event_id % 31 = 0 then null when event_id % 6 = 0 then 'Y' else 'N' end as suspicious_flag
from events where event_type = 'purchase'

-- finance_advance_report_raw
select 'ADV-'||lpad(cast(o_orderkey as string),9,'0') as src_advance_report_id, 'E'||lpad(cast(o_custkey as string),7,'0') as employee_src_id, cast(o_orderdate as date) as report_period,
 cast(o_totalprice as decimal(18,2)) as total_amount_rub, cast(o_totalprice as decimal(18,2)) as approved_amount_rub,
 case when o_orderkey % 13 = 0 then null when o_orderkey % 5 = 0 then cast(cast(o_totalprice as decimal(18,2)) * 0.10 as decimal(18,2)) else cast(0 as decimal(18,2)) end as rejected_amount_rub,
 case when o_orderkey % 7 = 0 then null when o_orderkey % 6 = 0 then cast(o_orderkey % 45 + 1 as int) else 0 end as overdue_days, case o_orderstatus when 'F' then 'CLOSED' when 'O' then 'IN_REVIEW' else 'APPROVED' end as report_status,
 cast(null as string) as approver_employee_src_id
from orders

-- finance_payroll_adjustment_raw
select 'PAY-'||lpad(cast(event_id as string),8,'0') as src_payroll_adj_id, 'E'||lpad(cast(event_id % (select count(*) from customer) as string),7,'0') as employee_src_id, cast(ts as date) as payroll_month, 'ADJ_'||cast(event_id % 4 as string) as adjustment_type_code,
 'Adjustment '||cast(event_id % 4 as string) as adjustment_type_name, 'G'||cast(event_id % 4 as string) as adjustment_reason_group, cast(cast(value as decimal(18,2)) - 50.00 as decimal(18,2)) as amount_rub,
 case when event_id % 19 = 0 then null when event_id % 2 = 0 then 'Y' else 'N' end as manual_flag, case when event_id % 8 = 0 then 'N' else 'Y' end as approved_flag
from events where event_type = 'signup'

-- finance_vendor_payment_raw
select 'VP-'||cast(l_orderkey as string)||'-'||cast(l_linenumber as string)||'-'||cast(l_partkey as string)||'-'||cast(l_suppkey as string) as src_vendor_payment_id,
 case when l_partkey % 5 = 0 then null else 'E'||lpad(cast(o_custkey as string),7,'0') end as employee_src_id, 'V'||lpad(cast(l_suppkey as string),5,'0') as vendor_src_id, s_name as vendor_name,
 cast(l_shipdate as date) as payment_date, cast(l_extendedprice as decimal(18,2)) as payment_amount_rub, 'PT'||cast(l_linenumber % 3 as string) as payment_type_code, 'Payment '||cast(l_linenumber % 3 as string) as payment_type_name,
 'CTR-'||cast(l_partkey % 800 as string) as contract_code, case when l_linenumber % 3 = 0 then 'Y' when l_partkey % 17 = 0 then null else 'N' end as urgent_flag
from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey where l_returnflag = 'N'

-- finance_budget_limit_raw
select 'BL-'||cast(n_nationkey as string)||'-'||cast(q as string) as src_budget_limit_id, 'CC_D'||lpad(cast(n_nationkey as string),4,'0') as cost_center_code, 'Centre '||n_name as cost_center_name,
 date '2024-01-01' + q as budget_period, cast(1000000 + n_nationkey * 1000 as decimal(18,2)) as budget_amount_rub, cast(1000000 + n_nationkey * 900 + q as decimal(18,2)) as consumed_amount_rub,
 case when n_nationkey * 900 + q > n_nationkey * 1000 then 'Y' else 'N' end as exceeded_flag
from (select *, 60 as q from nation union all select *, 152 as q from nation union all select *, 244 as q from nation union all select *, 335 as q from nation) n
