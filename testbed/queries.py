"""One query per operator or table, each over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import (
    band,
    decode_epoch_date,
    decode_epoch_range,
    decode_epoch_ts,
    hours_between,
    is_yes,
    register_functions,
    whole_second_hours,
)
from lamina.operators.dimensions import catalog_dim
from lamina.operators.keys import dense_key, tag_rows
from lamina.operators.lookups import lookup
from lamina.operators.quality import (
    content_parity,
    duplicate_keys,
    not_empty,
    required_nulls,
    row_parity,
)
from lamina.operators.staging import new_path
from lamina.plans.access import ACCESS, LOGIN_METRICS
from lamina.plans.base import Warehouse
from lamina.plans.build import (
    build_all,
    entity_buckets,
    migrate,
    read_checks,
    read_published,
    stored_raw,
    warehouse,
)
from lamina.plans.finance import FINANCE
from lamina.plans.hr import INSTABILITY, LOAD
from lamina.plans.risk import EVENT_SOURCES, RISK
from lamina.sources.files import (
    TIMESTAMP_WRITE_FORMAT,
    export_raw,
    load_csv,
    load_raw,
    read_raw,
    read_table,
    write_csv,
    write_table,
)
from lamina.sources.schemas import RAW, conform, raw_schema, raw_tables, required, table_schema
from testbed.bindings import bind, stored_raw_table

Query = Callable[[SparkSession, str], DataFrame]

# Query key -> table, mart or view of the warehouse.
WAREHOUSE = {
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
REPORTS = {
    "mart_hr": "hr.employee_hr_profile_report",
    "mart_risk": "risk.employee_operational_risk_report",
    "mart_access": "access.employee_access_control_report",
    "mart_finance": "finance.employee_finance_control_report",
    "view_hr_signals": "hr.v_employee_instability_signals",
    "view_risk_trend_one_date": "risk.v_employee_risk_trend",
    "view_access_exceptions": "access.v_privileged_access_exceptions",
    "view_finance_signals": "finance.v_employee_suspicious_expense_signals",
}


def open_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse over the stored raw tables of one scale factor."""
    return warehouse(lambda table: stored_raw_table(spark, sf_dir, table))


def _table(name: str) -> Query:
    return lambda spark, sf_dir: open_warehouse(spark, sf_dir).table(name, pinned=False)


def _report(name: str) -> Query:
    return lambda spark, sf_dir: open_warehouse(spark, sf_dir).report(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# ---- scalar functions


def flag_yn(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "array('Y', 'N', null, 'y', '', ' Y')[cast(event_id % 6 as int)]"
    flagged = _read(spark, sf_dir, "events").select("event_id", F.expr(text).alias("flag_text"))
    return flagged.withColumn("flag", is_yes("flag_text"))


def duration_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every tenth interval is open; the others last up to 4000 s, fractions of seconds included.
    end = "if(event_id % 10 = 0, null, timestampadd(MICROSECOND, event_id * 104729 % 4000000000, ts))"
    spans = _read(spark, sf_dir, "events").select("event_id", "ts", F.expr(end).alias("ended"))
    return spans.select(
        "event_id",
        hours_between("ts", "ended").alias("exact_hours"),
        whole_second_hours("ts", "ended").alias("second_hours"),
    )


def _event_micros(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col("ts"))
    return _read(spark, sf_dir, "events").select("event_id", "ts", micros.alias("us"))


def decode_epoch_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        case event_id % 10
            when 0 then cast(us div 1000000 as string)
            when 1 then cast(us div 1000 as string)
            when 2 then cast(us as string)
            when 3 then concat(us, lpad(event_id % 1000, 3, '0'))
            when 4 then date_format(ts, 'yyyy-MM-dd HH:mm:ss')
            when 5 then concat(us div 1000000, '7')
            when 6 then concat('-', us div 1000000)
            when 7 then concat('abc', event_id)
            when 8 then cast(us div 86400000000 as string)
        end"""
    values = _event_micros(spark, sf_dir).select("event_id", F.expr(text).alias("epoch_text"))
    return values.withColumn("decoded", decode_epoch_ts("epoch_text"))


def decode_epoch_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        case event_id % 10
            when 0 then cast(us div 1000000 as string)
            when 1 then cast(us div 1000 as string)
            when 2 then cast(us as string)
            when 3 then concat(us, lpad(event_id % 1000, 3, '0'))
            when 4 then date_format(ts, 'yyyy-MM-dd')
            when 5 then concat(us div 86400000000, '1')
            when 6 then concat('-', us div 86400000000)
            when 7 then concat('abc', event_id)
            when 8 then cast(us div 86400000000 as string)
        end"""
    values = _event_micros(spark, sf_dir).select("event_id", F.expr(text).alias("epoch_text"))
    return values.withColumn("decoded", decode_epoch_date("epoch_text"))


def decode_epoch_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = """
        case event_id % 8
            when 0 then us div 1000000
            when 1 then us div 1000
            when 2 then us
            when 3 then -(us div 1000000)
            when 4 then us div 86400000000
            when 5 then 32503679999 + event_id % 3
            when 6 then 32503679999999 + event_id % 3
        end"""
    values = _event_micros(spark, sf_dir).select("event_id", F.expr(number).alias("epoch_number"))
    return values.withColumn("decoded", decode_epoch_range("epoch_number"))


def score_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Steps of 0.01 from 0 to 16, every second one lowered by less than the rounding step.
    points = "cast((o_orderkey % 1601) * 0.01 - (o_custkey % 2) * 0.00004 as decimal(18,5))"
    scored = _read(spark, sf_dir, "orders").select("o_orderkey", F.expr(points).alias("points"))
    levels = {
        f"{subject}_level": band(F.col("points"), scoring.floors, scoring.otherwise)
        for subject, scoring in {
            "hr": INSTABILITY,
            "risk": RISK,
            "access": ACCESS,
            "finance": FINANCE,
        }.items()
    }
    return scored.withColumns(levels).withColumn("points", F.col("points").cast("decimal(18,4)"))


# ---- keys, aggregates, layouts


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tag_rows(_read(spark, sf_dir, "lineitem"))
    names = ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return dense_key(lines, "line_id", names, keep=names)


def surrogate_key_many_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tag_rows(_read(spark, sf_dir, "lineitem"))
    names = ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return dense_key(lines, "line_id", names, keep=names, slices=32)


def surrogate_key_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tag_rows(_read(spark, sf_dir, "lineitem"))
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    order = [f"cast({name} as string)" for name in names]
    return dense_key(lines, "line_id", order, keep=names)


def login_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    logins = open_warehouse(spark, sf_dir).rows("access.fct_employee_login_event")
    return logins.groupBy("employee_id").agg(
        *[F.expr(expression).alias(name) for name, expression in LOGIN_METRICS.items()]
    )


def schema_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = "finance_advance_report_raw"
    stored = stored_raw_table(spark, sf_dir, table)
    # All text, reversed, with a column the layout does not know.
    loose = stored.select(*[F.col(c).cast("string") for c in reversed(stored.columns)], F.lit(1).alias("x"))
    return conform(loose, raw_schema(table), text=("overdue_days",))


def view_risk_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Several report dates: one snapshot per customer and year of order.
    yearly = (
        _read(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_custkey").alias("employee_id"),
            F.trunc(F.col("o_orderdate").cast("date"), "year").alias("report_date"),
        )
        .agg(
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("risk_score_value"),
            F.lit("LOW").alias("risk_level_code"),
            F.count_if(F.col("o_orderstatus") == "O").alias("open_event_cnt"),
            F.count_if(F.col("o_orderstatus") == "F").alias("critical_event_cnt"),
            *[
                F.lit(0).cast("bigint").alias(name)
                for name in ("ib_event_cnt", "security_event_cnt", "compliance_event_cnt")
            ],
            F.count("*").alias("nonwork_signal_cnt"),
        )
    )
    wh = open_warehouse(spark, sf_dir)
    wh.adopt("risk.fct_employee_risk_snapshot", yearly)
    return wh.report("risk.v_employee_risk_trend")


# ---- sources and sinks


def src_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = "hr_dismissal_signals_raw"
    path = new_path(spark, "csv")
    write_csv(stored_raw_table(spark, sf_dir, table), path)
    return read_raw(spark, path, raw_schema(table))


def src_csv_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = "finance_advance_report_raw"
    path = new_path(spark, "csv")
    write_csv(stored_raw_table(spark, sf_dir, table), path)
    return read_raw(spark, path, raw_schema(table))


def src_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = "finance_vendor_payment_raw"
    path = new_path(spark, "parquet")
    export_raw(stored_raw_table(spark, sf_dir, table), path)
    return load_raw(spark, path, new_path(spark, "loaded"), raw_schema(table))


def src_parquet_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = "access_login_events_raw"
    path = new_path(spark, "parquet")
    # Times leave as microseconds since the epoch and come back as timestamps.
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    times = {c: F.timestamp_diff("MICROSECOND", epoch, F.col(c)) for c in ("login_dttm", "load_dttm")}
    export_raw(stored_raw_table(spark, sf_dir, table).withColumns(times), path)
    decode = dict.fromkeys(times, decode_epoch_ts)
    return load_raw(spark, path, new_path(spark, "loaded"), raw_schema(table), decode)


def _as_epochs(df: DataFrame, unit: str) -> DataFrame:
    """Times as integers of ``unit`` since the epoch and dates as day numbers."""
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    numbers = {}
    for field in df.schema:
        if isinstance(field.dataType, T.TimestampNTZType):
            numbers[field.name] = F.timestamp_diff(unit, epoch, F.col(field.name))
        elif isinstance(field.dataType, T.DateType):
            numbers[field.name] = F.unix_date(field.name)
    return df.withColumns(numbers)


# Unit in which the times of a subject leave, and one of its tables whose values are compared.
MIGRATED = {
    "hr": ("MILLISECOND", "hr_absence_events_raw"),
    "risk": ("MICROSECOND", "risk_security_incidents_raw"),
    "access": ("MICROSECOND", "access_file_operations_raw"),
    "finance": ("MILLISECOND", "finance_employee_expense_raw"),
}


def _parity(subject: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        unit = MIGRATED[subject][0]
        tables = raw_tables(subject)
        source = {t: _as_epochs(stored_raw_table(spark, sf_dir, t), unit) for t in tables}
        return migrate(spark, source, new_path(spark, "exported"), new_path(spark, "migrated"))

    return run


def _migrated(subject: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        unit, table = MIGRATED[subject]
        source = {table: _as_epochs(stored_raw_table(spark, sf_dir, table), unit)}
        target = new_path(spark, "migrated")
        migrate(spark, source, new_path(spark, "exported"), target)
        return stored_raw(spark, target)(table)

    return run


def _decoded_in_sql(function: str, column: str, values: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        register_functions(spark)
        given = values(spark, sf_dir).select("event_id", column)
        return spark.sql(f"select *, {function}({column}) as decoded from {{given}}", given=given)

    return run


def src_parquet_epoch_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = "hr_dismissal_signals_raw"
    path = new_path(spark, "parquet")
    # Times leave as milliseconds and are told from seconds by their size.
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    millis = F.timestamp_diff("MILLISECOND", epoch, F.col("detected_at"))
    export_raw(stored_raw_table(spark, sf_dir, table).withColumn("detected_at", millis), path)
    decode = {"detected_at": decode_epoch_range}
    return load_raw(spark, path, new_path(spark, "loaded"), raw_schema(table), decode)


def migration_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = {table: stored_raw_table(spark, sf_dir, table) for table in raw_tables("finance")}
    return migrate(spark, source, new_path(spark, "exported"), new_path(spark, "migrated"))


_PUBLISHED: dict[tuple[str, str], str] = {}


def _published(name: str) -> Query:
    """A mart of one full build, which all these queries of an application share."""

    return lambda spark, sf_dir: read_published(spark, _published_root(spark, sf_dir), name)


def _published_root(spark: SparkSession, sf_dir: str) -> str:
    slot = (spark.sparkContext.applicationId, sf_dir)
    if slot not in _PUBLISHED:
        root = new_path(spark, "warehouse")
        build_all(spark, lambda t: stored_raw_table(spark, sf_dir, t), root, "all")
        _PUBLISHED[slot] = root
    return _PUBLISHED[slot]


def published_mart_hr(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "warehouse")
    build_all(spark, lambda t: stored_raw_table(spark, sf_dir, t), root, "run", subjects=["hr"])
    return read_published(spark, root, "hr.employee_hr_profile_report")


def published_mart_hr_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, buckets = new_path(spark, "warehouse"), entity_buckets(8, ["hr"])
    build_all(
        spark, lambda t: stored_raw_table(spark, sf_dir, t), root, "run", subjects=["hr"], buckets=buckets
    )
    return read_published(spark, root, "hr.employee_hr_profile_report")


def sink_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table_schema("hr.fct_employee_position_history")
    facts = open_warehouse(spark, sf_dir).table("hr.fct_employee_position_history")
    path = new_path(spark, "refresh")
    write_table(facts.where("salary_change_flag"), path)
    write_table(facts, path, layout_key="employee_id")
    return read_table(spark, path, schema)


def src_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which lines load and why the others do not; three lines in a hundred records are broken."""
    table = "finance_advance_report_raw"
    schema = raw_schema(table)
    stored, path = stored_raw_table(spark, sf_dir, table), new_path(spark, "csv")
    write_csv(stored, f"{path}/good")
    times = [f.name for f in schema if isinstance(f.dataType, T.TimestampNTZType)]
    texts = {c: F.col(c).cast("string") for c in schema.names if c not in times}
    texts |= {c: F.date_format(c, TIMESTAMP_WRITE_FORMAT) for c in times}
    broken = stored.where("src_advance_report_id like '%07'").withColumns(texts)
    variants = {
        "type": {"overdue_days": F.lit("n/a")},
        "more": {"batch_id": F.concat("batch_id", F.lit(",extra"))},
        # A second, short line after a whole one, which is broken as well.
        "fewer": {
            "overdue_days": F.lit("?"),
            "batch_id": F.concat("batch_id", F.lit("\n"), "src_advance_report_id", F.lit(","), "employee_src_id"),
        },
    }
    for name, columns in variants.items():
        broken.withColumns(columns).write.options(header="true", quote="").csv(f"{path}/{name}")
    target, rejects = new_path(spark, "loaded"), new_path(spark, "rejects")
    loaded = load_csv(spark, f"{path}/*", target, rejects, schema)
    lines = spark.read.parquet(rejects).selectExpr(
        "substring_index(line, ',', 1) as src_advance_report_id", "reason"
    )
    return loaded.selectExpr("src_advance_report_id", "'loaded' as reason").unionByName(lines)


# ---- quality checks


def dq_row_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = {table: bind(spark, sf_dir, table) for table in RAW}
    return row_parity(source, {table: stored_raw_table(spark, sf_dir, table) for table in RAW})


def dq_row_parity_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = {table: stored_raw_table(spark, sf_dir, table) for table in raw_tables("risk")}
    lost = {table: df.where("load_dttm is null") for table, df in source.items()}
    return row_parity(source, {**source, "risk_ib_incidents_raw": lost["risk_ib_incidents_raw"]})


#: Ranges of the contents that are compared: a thousand record numbers each.
_THOUSANDS = "substr({0}, 1, length({0}) - 3)"


def _ranges(tables: list[str]) -> dict[str, str]:
    return {table: _THOUSANDS.format(raw_schema(table).names[0]) for table in tables}


def dq_content_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = raw_tables("finance")
    source = {table: bind(spark, sf_dir, table) for table in tables}
    target = {table: stored_raw_table(spark, sf_dir, table) for table in tables}
    return content_parity(source, target, _ranges(tables))


def dq_content_parity_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value in five thousand records is another one on the target's side, none is lost."""
    tables = ["access_system_accounts_raw", "access_login_events_raw"]
    source = {table: stored_raw_table(spark, sf_dir, table) for table in tables}
    changed = source["access_login_events_raw"].withColumn(
        "device_id", F.expr("if(right(src_login_event_id, 4) in ('0042', '5042'), 'changed', device_id)")
    )
    return content_parity(source, {**source, "access_login_events_raw": changed}, _ranges(tables))


def dq_required_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_checks(spark, _published_root(spark, sf_dir))


def dq_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {table: stored_raw_table(spark, sf_dir, table) for table in raw_tables("access")}
    untyped = tables["access_login_events_raw"].where("auth_method is null")
    return not_empty({**tables, "logins_without_method": untyped})


def dq_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = "finance_vendor_payment_raw"
    columns = [*required(raw_schema(table)), "employee_src_id", "urgent_flag"]
    return required_nulls(stored_raw_table(spark, sf_dir, table), columns)


def _types_with_two_severities(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    raw = stored_raw_table(spark, sf_dir, "risk_ib_incidents_raw").withColumn(
        "severity_level", F.expr("if(src_incident_id like '%0', 'HIGH', 'LOW')")
    )
    kinds = EVENT_SOURCES[0].kind(raw)
    types = catalog_dim([kinds], [c for c in kinds.columns if c not in LOAD])
    return raw, types


def dq_unique_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, types = _types_with_two_severities(spark, sf_dir)
    return duplicate_keys(types, ["source_system_name", "source_event_code"])


def lookup_cast_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    accounts = open_warehouse(spark, sf_dir).table("access.fct_employee_account")
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    account = "concat('ACC-', lpad(cast(o_orderkey as string), 9, '0'))"
    take = {"employee_account_id": "employee_account_id", "employee_id": "employee_id"}
    return lookup(orders, accounts, {account: "source_account_id"}, take)


def lookup_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, types = _types_with_two_severities(spark, sf_dir)
    events = raw.select("src_incident_id", "incident_code")
    on = {"incident_code": "source_event_code"}
    return lookup(events, types, on, {"default_severity_level": "default_severity_level"})


QUERIES: dict[str, Query] = {
    **{key: _table(name) for key, name in WAREHOUSE.items()},
    **{key: _report(name) for key, name in REPORTS.items()},
    "view_risk_trend": view_risk_trend,
    "flag_yn": flag_yn,
    "duration_hours": duration_hours,
    "decode_epoch_digits": decode_epoch_digits,
    "decode_epoch_date": decode_epoch_dates,
    "decode_epoch_range": decode_epoch_ranges,
    "score_bands": score_bands,
    "sql_decode_epoch_ts": _decoded_in_sql("decode_epoch_ts", "epoch_text", decode_epoch_digits),
    "sql_decode_epoch_date": _decoded_in_sql("decode_epoch_date", "epoch_text", decode_epoch_dates),
    "sql_decode_epoch_range": _decoded_in_sql(
        "decode_epoch_range", "epoch_number", decode_epoch_ranges
    ),
    "surrogate_key": surrogate_key,
    "surrogate_key_many_slices": surrogate_key_many_slices,
    "surrogate_key_cast": surrogate_key_cast,
    "login_counts": login_counts,
    "schema_conform": schema_conform,
    "src_csv_roundtrip": src_csv_roundtrip,
    "src_csv_money": src_csv_money,
    "src_csv_rejects": src_csv_rejects,
    "src_parquet_roundtrip": src_parquet_roundtrip,
    "src_parquet_epochs": src_parquet_epochs,
    "src_parquet_epoch_range": src_parquet_epoch_range,
    "migration_parity": migration_parity,
    **{f"migration_parity_{subject}": _parity(subject) for subject in MIGRATED},
    **{f"migrated_{subject}": _migrated(subject) for subject in MIGRATED},
    "published_mart_hr": published_mart_hr,
    "published_mart_risk": _published("risk.employee_operational_risk_report"),
    "published_mart_access": _published("access.employee_access_control_report"),
    "published_mart_finance": _published("finance.employee_finance_control_report"),
    "published_mart_hr_bucketed": published_mart_hr_bucketed,
    "sink_full_refresh": sink_full_refresh,
    "dq_row_parity": dq_row_parity,
    "dq_row_parity_lost": dq_row_parity_lost,
    "dq_content_parity": dq_content_parity,
    "dq_content_parity_changed": dq_content_parity_changed,
    "dq_required_detail": dq_required_detail,
    "dq_not_empty": dq_not_empty,
    "dq_required": dq_required,
    "dq_unique_key": dq_unique_key,
    "lookup_fanout": lookup_fanout,
    "lookup_cast_key": lookup_cast_key,
}
