"""The raw tables take every row of their source and reach every employee."""

from __future__ import annotations

from pyspark.sql import functions as F

from testbed.bindings import BINDINGS, bind

LARGER = "/root/testdata/sf0.1"


def test_events_reach_the_employees_of_a_larger_table(spark):
    overtime = bind(spark, LARGER, "hr_overtime_events_raw")
    assert overtime.agg(F.count_distinct("employee_src_id")).first()[0] > 10_000


def test_every_order_is_an_account_and_every_line_an_assignment(spark, sf_dir):
    rows = lambda table: bind(spark, sf_dir, table).count()
    orders, lines = (spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("orders", "lineitem"))
    assert rows("access_system_accounts_raw") == orders
    assert rows("access_role_assignments_raw") == rows("access_privileged_access_raw") == lines


def test_no_row_is_dropped_by_a_remainder():
    assert not [t for t, sql in BINDINGS.items() if "%" in sql.rpartition(" where ")[2] and " where " in sql and "from nation" not in sql and "from customer" not in sql]
