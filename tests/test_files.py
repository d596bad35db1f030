from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from lamina.functions import decode_epoch_date, decode_epoch_ts
from lamina.sources.files import (
    SchemaMismatch,
    epoch_decoders,
    export_raw,
    load_csv,
    load_raw,
    read_bucketed,
    read_jdbc,
    read_raw,
    read_table,
    save_bucketed,
    write_csv,
    write_table,
)
from lamina.sources.schemas import RAW, conform, parse, raw_schema, required

BUDGETS = """src_budget_limit_id,cost_center_code,cost_center_name,budget_period,budget_amount_rub,consumed_amount_rub,exceeded_flag,source_system,load_dttm,batch_id
BL-1,CC_1,"Centre ""A"", north",2024-03-01,1941876.74,,N,budget,2024-12-31 12:00:00,b1
BL-2,CC_2,Центр,2024-06-01,10.00,11.50,,budget,2024-12-31 12:00:00.250000,b1
"""


def test_csv_types_quotes_and_empty_values(spark, tmp_path):
    path = tmp_path / "budgets.csv"
    path.write_text(BUDGETS, encoding="utf-8")
    rows = read_raw(spark, str(path), raw_schema("finance_budget_limit_raw")).collect()
    assert [tuple(row)[:7] for row in rows] == [
        ("BL-1", "CC_1", 'Centre "A", north', date(2024, 3, 1), Decimal("1941876.74"), None, "N"),
        ("BL-2", "CC_2", "Центр", date(2024, 6, 1), Decimal("10.00"), Decimal("11.50"), None),
    ]
    assert rows[1]["load_dttm"] == datetime(2024, 12, 31, 12, 0, 0, 250000)


def test_csv_errors_are_raised(spark, tmp_path):
    schema = raw_schema("finance_budget_limit_raw")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_raw(spark, str(tmp_path / "missing.csv"), schema)
    malformed = tmp_path / "malformed.csv"
    malformed.write_text(BUDGETS.replace("10.00", "ten"), encoding="utf-8")
    with pytest.raises((PySparkException, Py4JJavaError), match="MALFORMED_RECORD"):
        read_raw(spark, str(malformed), schema).collect()
    renamed = tmp_path / "renamed.csv"
    renamed.write_text(BUDGETS.replace("exceeded_flag", "late_flag"), encoding="utf-8")
    with pytest.raises((PySparkException, Py4JJavaError), match="(?i)header"):
        read_raw(spark, str(renamed), schema).collect()


def test_csv_keeps_line_breaks_in_multiline_mode(spark, tmp_path):
    schema = parse("a STRING, b INT")
    written = spark.createDataFrame([('first\nsecond "x"', 1), (None, 2)], "a string, b int")
    path = str(tmp_path / "lines")
    write_csv(written, path)
    found = read_raw(spark, path, schema, multiline=True)
    assert sorted(map(tuple, found.collect()), key=repr) == [('first\nsecond "x"', 1), (None, 2)]


def test_full_refresh_replaces_everything(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = parse("id BIGINT, code STRING")
    rows = spark.range(100).selectExpr("id", "concat('c', id % 4) as code")
    write_table(rows, path)
    write_table(rows.where("id < 10"), path, layout_key="code")
    assert read_table(spark, path, schema).count() == 10


def test_layout_key_gathers_keys_and_splits_a_hot_one(spark, confs, tmp_path):
    confs(
        adaptive__advisoryPartitionSizeInBytes="20000",
        adaptive__coalescePartitions__parallelismFirst="false",
    )
    rows = spark.range(0, 200000, 1, 8).selectExpr(
        "id", "if(id % 3 = 0, 0, id % 1000) as k", "uuid() as payload"
    )
    path = str(tmp_path / "table")
    write_table(rows, path, layout_key="k")
    stored = spark.read.parquet(path).withColumn("file", F.input_file_name())
    files = stored.groupBy("k").agg(F.countDistinct("file").alias("n"))
    assert files.where("k = 0").first()["n"] > 1
    assert stored.count() == 200000


def test_bucketed_tables_join_without_a_shuffle(spark, confs, tmp_path):
    confs(autoBroadcastJoinThreshold="-1")
    for name in ("left_side", "right_side"):
        df = spark.range(1000).selectExpr("id % 50 as employee_id", f"id as {name}_n")
        save_bucketed(df, name, str(tmp_path / name), "employee_id", buckets=4)
    joined = spark.table("left_side").join(spark.table("right_side"), "employee_id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 50 * 20 * 20
    spark.sql("drop table left_side")
    spark.sql("drop table right_side")


def test_empty_tables_keep_their_schema(spark, tmp_path):
    schema = raw_schema("hr_absence_events_raw")
    path = str(tmp_path / "empty")
    export_raw(spark.createDataFrame([], schema), path)
    found = load_raw(spark, path, str(tmp_path / "loaded"), schema)
    assert found.count() == 0
    assert [f.dataType for f in found.schema] == [f.dataType for f in schema]


def test_load_refuses_other_columns(spark, tmp_path):
    schema = parse("a STRING, b INT")
    for name, columns in {"more": "a string, b int, c int", "fewer": "a string"}.items():
        path = str(tmp_path / name)
        export_raw(spark.createDataFrame([], columns), path)
        with pytest.raises(SchemaMismatch, match="one side only"):
            load_raw(spark, path, str(tmp_path / "target"), schema)


def test_load_decodes_epoch_columns(spark, tmp_path):
    schema = parse("id INT, at TIMESTAMP_NTZ, day DATE")
    path = str(tmp_path / "epochs")
    export_raw(spark.sql("select 1 as id, 1704067200123456L as at, 19723 as day"), path)
    decode = {"at": decode_epoch_ts, "day": decode_epoch_date}
    row = load_raw(spark, path, str(tmp_path / "target"), schema, decode).first()
    assert tuple(row) == (1, datetime(2024, 1, 1, 0, 0, 0, 123456), date(2024, 1, 1))


def test_conform_orders_casts_and_drops(spark):
    loose = spark.sql("select '5' as n, 'x' as extra, '2024-01-02' as d, 7 as label")
    found = conform(loose, parse("d DATE, n BIGINT, label STRING"))
    assert found.dtypes == [("d", "date"), ("n", "bigint"), ("label", "string")]
    assert tuple(found.first()) == (date(2024, 1, 2), 5, "7")
    as_text = conform(loose, parse("d DATE, n BIGINT"), text=("n",))
    assert as_text.dtypes == [("d", "date"), ("n", "string")]


def test_every_raw_layout_ends_with_required_audit_columns():
    assert len(RAW) == 24
    for table in RAW:
        names = raw_schema(table).names
        assert names[-3:] == ["source_system", "load_dttm", "batch_id"]
        assert set(names[-3:]) <= set(required(raw_schema(table)))


def test_jdbc_scan_is_split_by_key():
    class Reader:
        def jdbc(self, *args, **kwargs):
            return args, kwargs

    class Session:
        read = Reader()

    args, kwargs = read_jdbc(Session(), "jdbc:x", "raw.t", "id", (1, 100), 16, {"user": "u"})
    assert args == ("jdbc:x", "raw.t")
    assert kwargs == {
        "column": "id",
        "lowerBound": 1,
        "upperBound": 100,
        "numPartitions": 16,
        "properties": {"user": "u"},
    }


def test_load_refuses_other_types_and_decodes_integers(spark, tmp_path):
    schema = parse("amount DECIMAL(18,2), at TIMESTAMP_NTZ")
    files = str(tmp_path / "files")
    doubles = spark.sql("select 0.567D as amount, timestamp_ntz'2024-01-01 00:00:00' as at")
    doubles.write.parquet(files)
    with pytest.raises(SchemaMismatch, match="amount is double"):
        load_raw(spark, files, str(tmp_path / "out"), schema)
    epochs = spark.sql("select cast(1 as decimal(18,2)) as amount, 1704067200L as at")
    epochs.write.mode("overwrite").parquet(files)
    with pytest.raises(SchemaMismatch, match="at is bigint"):
        load_raw(spark, files, str(tmp_path / "out"), schema)
    loaded = load_raw(spark, files, str(tmp_path / "out"), schema, {"at": decode_epoch_ts})
    assert str(loaded.first()["at"]) == "2024-01-01 00:00:00"


def test_every_time_of_the_raw_tables_has_a_decoder(spark):
    for table in RAW:
        times = {f.name for f in raw_schema(table) if f.dataType.typeName() in ("date", "timestamp_ntz")}
        assert set(epoch_decoders(table)) == times


BROKEN = BUDGETS + """BL-3,CC_3,"Quoted, name",2024-13-41,1.00,,N,budget,2024-12-31 12:00:00,b1
BL-4,CC_4,Two faults,2024-01-01,one,,N,budget,yesterday,b1
BL-5,CC_5,"Quoted, name",2024-01-01,1.00,,N,budget,2024-12-31 12:00:00,b1,more
BL-6,CC_6
BL-7,CC_7,Whole,2024-01-01,1.00,,N,budget,2024-12-31 12:00:00,b1
"""


def test_lines_that_do_not_parse_are_kept_apart(spark, tmp_path):
    schema = raw_schema("finance_budget_limit_raw")
    path, target, rejects = (str(tmp_path / n) for n in ("broken.csv", "loaded", "rejects"))
    (tmp_path / "broken.csv").write_text(BROKEN, encoding="utf-8")
    loaded = load_csv(spark, path, target, rejects, schema)
    assert sorted(r.src_budget_limit_id for r in loaded.collect()) == ["BL-1", "BL-2", "BL-7"]
    assert loaded.where("src_budget_limit_id <> 'BL-7'").exceptAll(_good(spark, tmp_path, schema)).isEmpty()
    found = {r.line[:4]: r for r in spark.read.parquet(rejects).collect()}
    assert {k: r.reason for k, r in found.items()} == {
        "BL-3": "budget_period is no date: 2024-13-41",
        "BL-4": "budget_amount_rub is no decimal(18,2): one; load_dttm is no timestamp_ntz: yesterday",
        "BL-5": "11 values instead of 10",
        "BL-6": "2 values instead of 10",
    }
    assert all(r.line in BROKEN.splitlines() and r.file.endswith("broken.csv") for r in found.values())


def _good(spark, tmp_path, schema):
    (tmp_path / "good.csv").write_text(BUDGETS, encoding="utf-8")
    return read_raw(spark, str(tmp_path / "good.csv"), schema)


def test_files_without_broken_lines_leave_an_empty_reject_table(spark, tmp_path):
    schema = raw_schema("finance_budget_limit_raw")
    target, rejects = str(tmp_path / "loaded"), str(tmp_path / "rejects")
    good = _good(spark, tmp_path, schema)
    for _ in range(2):  # a second load replaces both tables
        loaded = load_csv(spark, str(tmp_path / "good.csv"), target, rejects, schema)
        assert loaded.exceptAll(good).isEmpty() and good.exceptAll(loaded).isEmpty()
        left = spark.read.parquet(rejects)
        assert left.columns == ["line", "reason", "file"] and left.isEmpty()


def test_line_breaks_in_values_load_with_multiline(spark, tmp_path):
    schema = raw_schema("finance_budget_limit_raw")
    text = BUDGETS.replace("Центр", '"two\nlines"') + "BL-9,short\n"
    (tmp_path / "multi.csv").write_text(text, encoding="utf-8")
    loaded = load_csv(spark, str(tmp_path / "multi.csv"), str(tmp_path / "t"), str(tmp_path / "r"), schema, multiline=True)
    assert {r.cost_center_name for r in loaded.collect()} == {'Centre "A", north', "two\nlines"}
    assert [r.reason for r in spark.read.parquet(str(tmp_path / "r")).collect()] == ["2 values instead of 10"]


def test_bucketed_tables_are_read_with_their_layout(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id % 100 as k", "cast(id as string) as v")
    path = str(tmp_path / "bucketed")
    save_bucketed(rows, "files_bucketed_once", path, "k", 4)
    spark.sql("drop table files_bucketed_once")  # as a new session, which only knows the path
    again = read_bucketed(spark, "files_bucketed_twice", path, rows.schema, "k", 4)
    assert again.exceptAll(rows).isEmpty() and again.count() == 1000
    plan = again.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert len(again.inputFiles()) == 4
