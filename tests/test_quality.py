from __future__ import annotations

import pytest
from pyspark.sql import Observation

from lamina.operators.quality import (
    CheckFailed,
    content_parity,
    duplicate_keys,
    not_empty,
    observe_nulls,
    observed_nulls,
    require,
    require_none,
    required_nulls,
    row_parity,
)


def lines(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_parity_counts_empty_tables_too(spark):
    source = {"a": spark.range(3), "b": spark.range(0), "c": spark.range(2)}
    target = {"a": spark.range(3), "b": spark.range(0), "c": spark.range(5)}
    parity = row_parity(source, target)
    assert lines(parity) == [("a", 3, 3, True), ("b", 0, 0, True), ("c", 2, 5, False)]
    with pytest.raises(CheckFailed, match="moved: .*'src_cnt': 2, 'dst_cnt': 5"):
        require(parity, "moved")


def test_parity_refuses_different_table_lists(spark):
    with pytest.raises(ValueError, match="b"):
        row_parity({"a": spark.range(1)}, {"a": spark.range(1), "b": spark.range(1)})


def test_not_empty(spark):
    found = not_empty({"full": spark.range(3), "empty": spark.range(0)})
    assert lines(found) == [("empty", False), ("full", True)]
    with pytest.raises(CheckFailed, match="empty"):
        require(found, "marts")


def test_required_nulls_in_one_pass(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    found = required_nulls(df, ["a", "b"])
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    assert lines(found) == [("a", 1, False), ("b", 2, False)]


def test_duplicate_keys_ignore_null_keys(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1)], "code string, n int"
    )
    assert lines(duplicate_keys(df, ["code", "n"])) == [("a", 1, 2)]


def contents_of(spark, rows):
    return spark.createDataFrame(rows, "k string, x string, n int")


def test_contents_are_compared_by_range_and_in_any_order(spark):
    rows = [(f"a{k // 10}", f"v{k}", k) for k in range(40)] + [(None, None, None), ("a0", "v0", 0)]
    source = contents_of(spark, rows)
    ranges = {"t": "k"}
    same = content_parity({"t": source}, {"t": contents_of(spark, rows[::-1]).repartition(3)}, ranges)
    assert all(r.ok for r in same.collect()) and same.count() == 5
    # Equal counts: a changed value, two values that change places, a NULL in another column, another copy.
    for changed, where in (
        ([(k, "other" if n == 7 else x, n) for k, x, n in rows], "a0"),
        ([("a1", "v12", 11) if n == 11 else ("a1", "v11", 12) if n == 12 else (k, x, n) for k, x, n in rows], "a1"),
        ([("a2", None, 25) if n == 25 else (k, x, n) for k, x, n in rows], "a2"),
        ([*rows[:-1], ("a0", "v1", 1)], "a0"),
    ):
        found = content_parity({"t": source}, {"t": contents_of(spark, changed)}, ranges).where("not ok").collect()
        assert [(r.table_name, r.key_range, r.src_cnt == r.dst_cnt) for r in found] == [("t", where, True)]


def test_lost_ranges_count_zero_rows(spark):
    source = {"t": contents_of(spark, [("a", "x", 1), ("b", "y", 2)]), "e": contents_of(spark, [])}
    target = {"t": source["t"].where("k = 'a'"), "e": source["e"]}
    parity = content_parity(source, target, {"t": "k", "e": "k"})
    assert lines(parity) == [("t", "a", 1, 1, True), ("t", "b", 1, 0, False)]
    with pytest.raises(CheckFailed, match="moved: .*'key_range': 'b'"):
        require(parity, "moved")
    with pytest.raises(ValueError, match="columns differ"):
        content_parity({"t": source["t"]}, {"t": source["t"].drop("n")}, {"t": "k"})


def test_nulls_are_counted_while_rows_are_written(spark, tmp_path):
    seen = Observation()
    rows = contents_of(spark, [("a", None, 1), (None, None, 2)])
    observe_nulls(rows, ["k", "x", "n"], seen).write.parquet(str(tmp_path / "t"))
    assert seen.get == {"k": 1, "x": 2, "n": 0}
    require_none(seen.get, ["k", "x"], "t")
    with pytest.raises(CheckFailed, match="t: x: 2"):
        require_none(seen.get, ["k"], "t")
    found = observed_nulls(spark, {"t": seen.get, "u": {}}, {"t": ["k"], "u": []})
    assert lines(found) == [("t", "k", True, 1, True), ("t", "n", False, 0, True), ("t", "x", False, 2, False)]
    assert observed_nulls(spark, {}, {}).count() == 0
