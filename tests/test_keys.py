from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from lamina.operators import keys
from lamina.operators.keys import ROW, dense_key, slices_for, tag_rows
from lamina.operators.staging import stage
from lamina.sources.files import write_table


def many_slices(confs):
    """Keep adaptive execution from merging the small slices of a test."""
    confs(adaptive__coalescePartitions__enabled="false")


def numbered(df, key="id"):
    return [tuple(row) for row in df.orderBy(key).collect()]


def test_matches_a_global_sort_over_many_slices(spark, confs, sf_dir):
    many_slices(confs)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    names = ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    keyed = dense_key(lines, "id", names, keep=names, slices=8)
    found = numbered(keyed)
    expected = sorted(tuple(row) for row in lines.select(*names).collect())
    assert [row[0] for row in found] == list(range(1, len(expected) + 1))
    assert [row[1:] for row in found] == expected
    assert "BroadcastHashJoin" in keyed._jdf.queryExecution().executedPlan().toString()


def test_hot_leading_value_spreads_over_slices(spark, confs, monkeypatch):
    many_slices(confs)
    staged = []
    monkeypatch.setattr(keys, "stage", lambda df, label: staged.append(stage(df, label)) or staged[-1])
    # Every second row has the same leading value.
    rows = spark.range(8000).selectExpr("if(id % 2 = 0, 'hot', concat('k', id)) as code", "id as n")
    found = numbered(dense_key(rows, "key", ["code", "n"], slices=8), "key")
    assert [row[1:] for row in found] == sorted(row[1:] for row in found)
    per_slice = staged[0].groupBy(F.expr("_pos >> 33")).count().collect()
    assert len(per_slice) == 8
    assert max(row["count"] for row in per_slice) < 3000


def test_copies_of_one_row_spread_over_slices(spark, confs, monkeypatch):
    many_slices(confs)
    staged = []
    monkeypatch.setattr(keys, "stage", lambda df, label: staged.append(stage(df, label)) or staged[-1])
    stored = stage(
        spark.range(9000).selectExpr("if(id % 3 = 0, 'copy', concat('k', id)) as code"), "copies"
    )
    keyed = dense_key(tag_rows(stored), "key", ["code"], slices=8)
    assert keyed.columns == ["key", "code"]
    found = numbered(keyed, "key")
    assert [row[0] for row in found] == list(range(1, 9001))
    assert [row[1] for row in found] == sorted(row[1] for row in found)
    per_slice = staged[-1].groupBy(F.expr("_pos >> 33")).count().collect()
    assert max(row["count"] for row in per_slice) < 2500


def test_nulls_come_last(spark):
    rows = spark.createDataFrame([("b",), (None,), ("a",)], "code string")
    assert numbered(dense_key(rows, "id", ["code"])) == [(1, "a"), (2, "b"), (3, None)]


def test_expressions_order_and_need_not_be_kept(spark):
    rows = spark.createDataFrame([("a", 2), ("b", None), ("c", 1)], "code string, n int")
    keyed = dense_key(rows, "id", ["coalesce(n, 0)"], keep=["code"])
    assert numbered(keyed) == [(1, "b"), (2, "c"), (3, "a")]


def test_equal_positions_get_the_same_keys_every_time(spark, confs):
    many_slices(confs)
    rows = spark.range(2000).selectExpr("id % 7 as code", "id as payload")
    first = numbered(dense_key(rows.repartition(3), "key", ["code"], slices=8), "key")
    second = numbered(dense_key(rows.repartition(5), "key", ["code"], slices=5), "key")
    third = numbered(dense_key(rows.repartition(2), "key", ["code"]), "key")
    assert first == second == third


def test_empty_input(spark):
    empty = spark.createDataFrame([], "code string")
    keyed = dense_key(empty, "id", ["code"])
    assert keyed.columns == ["id", "code"]
    assert keyed.count() == 0


def test_no_single_task_sees_the_table(spark, sf_dir, monkeypatch):
    plans = []

    def spying(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, label)

    monkeypatch.setattr(keys, "stage", spying)
    lines = tag_rows(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    dense_key(lines, "id", ["l_returnflag", "l_orderkey"], keep=["l_orderkey"], slices=8)
    assert "shufflepartitionidpassthrough" in plans[0].lower()
    assert ROW in plans[0]
    assert "rangepartitioning" not in plans[0]  # its bounds would cost a pass of their own
    assert "SinglePartition" not in plans[0]
    assert "Window" not in plans[0]


def counting(df, seen):
    """``df`` whose every computed row adds one to the accumulator ``seen``."""

    def run(parts):
        for part in parts:
            seen.add(part.num_rows)
            yield part

    return df.mapInArrow(run, df.schema)


@pytest.mark.parametrize("slices", [None, 8])
def test_rows_are_computed_once(spark, sf_dir, slices):
    seen = spark.sparkContext.accumulator(0)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_shipdate")
    keyed = dense_key(counting(lines, seen), "id", ["l_orderkey"], slices=slices)
    assert keyed.count() == lines.count() == seen.value
    keyed.agg(F.max("id")).collect()
    assert seen.value == lines.count()


def test_slices_follow_the_staged_bytes(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(keys, "stage", lambda df, label: staged.append(stage(df, label)) or staged[-1])
    numbers = []
    for n in (20_000, 200_000):
        rows = spark.range(n).selectExpr("sha2(cast(id as string), 256) as code")
        found = dense_key(rows, "key", ["code"], slice_bytes=300_000)
        assert found.agg(F.max("key"), F.count("*")).first()[:] == (n, n)
        per_slice = [r["count"] for r in staged[-1].groupBy(F.expr("_pos >> 33")).count().collect()]
        assert max(per_slice) < 2 * n / len(per_slice)
        numbers.append(len(per_slice))
    assert 8 <= numbers[1] / numbers[0] <= 12
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_slices_grow_with_the_table_up_to_any_size():
    mib, tib = 1024**2, 1024**4
    assert [slices_for(n * mib) for n in (0, 1, 16, 17, 160, 1600, 64_000)] == [1, 1, 1, 2, 10, 100, 4000]
    assert (slices_for(tib // 2), slices_for(tib)) == (4000, 4096)
    assert slices_for(40 * tib) == 40 * tib // (256 * mib)


def test_levels_are_samples_in_files_of_their_own(spark):
    rows = spark.range(80_000).selectExpr("id", "monotonically_increasing_id() as _place")
    staged, path, counts = keys._stage_levels(rows, "levels")
    assert counts[0] == 80_000
    for above, below in zip(counts[1:4], counts[:3], strict=True):
        assert 0.5 < 8 * above / below < 2
    sample = staged.where("_level >= 2")
    assert sample.count() == counts[2]
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_level#\d+ >= 2", plan)
    assert keys.stored_bytes(spark, path) > 80_000


def test_bounds_keep_the_order_of_every_type(spark):
    rows = spark.range(3000).selectExpr(
        "if(id % 7 = 0, null, date_add(date'0001-01-01', cast(id * 1000 as int))) as d",
        "if(id % 5 = 0, null, timestampadd(MICROSECOND, id * 12345678901, timestamp_ntz'1969-12-31 23:59:59.000001')) as t",
        "if(id % 3 = 0, null, cast((id - 1500) * 0.37 as decimal(38,18))) as x",
        "if(id % 11 = 0, null, concat('\"\\\\,\n', char(233 + id % 20), id)) as s",
        "id % 2 = 0 as b",
        "encode(lpad(cast(id as string), 5, '0'), 'utf-8') as raw",
        "if(id % 13 = 0, double('NaN'), (1500 - id) / 7) as f",
    )
    for order in (["d", "s"], ["t"], ["x", "t"], ["s"], ["b", "raw"], ["f", "s"], ["coalesce(x, 0)", "raw"]):
        keyed = dense_key(rows, "key", order, slices=16)
        sort = [F.expr(o).asc_nulls_last() for o in order]
        want = [r[0] for r in rows.orderBy(*sort, "raw").select(F.struct(*[F.expr(o) for o in order])).collect()]
        found = [r[0] for r in keyed.orderBy("key").select(F.struct(*[F.expr(o) for o in order])).collect()]
        assert str(found) == str(want)


def test_nulls_tell_rows_apart(spark, confs):
    """Rows that differ only in where a NULL stands are ordered alike in every build."""
    many_slices(confs)
    rows = [(n % 3, None if n % 2 else "a", "a" if n % 2 else None) for n in range(400)]
    builds = []
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "g long, x string, y string").repartition(parts)
        builds.append(numbered(dense_key(df, "id", ["g"])))
    assert builds[0] == builds[1]


def test_slices_are_as_many_as_asked_for(spark, confs, monkeypatch):
    staged = []
    monkeypatch.setattr(keys, "stage", lambda df, label: staged.append(stage(df, label)) or staged[-1])
    found = numbered(dense_key(spark.range(5000).toDF("n"), "id", ["n"], slices=16))
    assert found == [(n + 1, n) for n in range(5000)]
    assert staged[0].groupBy(F.expr("_pos >> 33")).count().count() == 16


def test_rows_are_dealt_by_compiled_halving(spark, sf_dir, monkeypatch):
    plans = []

    def spying(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, label)

    monkeypatch.setattr(keys, "stage", spying)
    lines = tag_rows(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    order = ["cast(l_orderkey as string)", "cast(l_partkey as string)"]
    dense_key(lines, "id", order, keep=["l_orderkey"], slices=40)
    assert "lambda" not in plans[0]  # a function over the array of bounds is interpreted, row by row


@pytest.mark.parametrize("slices", [2, 3, 8, 9, 40])
def test_a_row_is_in_the_slice_of_the_last_bound_it_reached(spark, slices):
    rows = spark.range(100).selectExpr("if(id % 10 = 9, null, id) as n")
    whole = keys._order_key(["n"])
    bounds = keys._bounds(rows, whole, slices)
    dealt = keys._with_slice(rows, whole, bounds, slices)
    assert dealt.columns == ["n", "_slice"]
    reached = F.size(F.filter(bounds, lambda b: b <= whole))
    assert dealt.where(F.col("_slice") != reached).count() == 0
    assert dealt.select("_slice").distinct().count() > slices // 2  # rows that are equal share theirs


def test_levels_are_written_without_a_sort_and_the_option_is_put_back(spark):
    asked = spark.conf.get(keys.OPEN_FILES)
    seen = []
    with keys._open_files(spark, 7):
        with keys._open_files(spark, 7):
            seen.append(spark.conf.get(keys.OPEN_FILES))
        seen.append(spark.conf.get(keys.OPEN_FILES))
    assert seen == ["7", "7"]
    assert spark.conf.get(keys.OPEN_FILES) == asked


def test_staged_rows_carry_no_hash_and_no_second_number(spark, monkeypatch):
    schemas = []
    staging = keys._stage_levels
    monkeypatch.setattr(keys, "_stage_levels", lambda df, *more: schemas.append(df.columns) or staging(df, *more))
    stored = stage(spark.range(50).selectExpr("id % 5 as code", "id as n"), "few")
    found = numbered(dense_key(tag_rows(stored), "key", ["code"]), "key")
    assert numbered(dense_key(stored, "key", ["code"]), "key") == found
    assert [row[:2] for row in found] == [(k + 1, k // 10) for k in range(50)]
    assert schemas == [["code", "n", ROW], ["code", "n", "_place"]]


def test_stored_tables_are_compressed_for_size(spark, tmp_path):
    rows = spark.range(50_000).selectExpr("concat('E', lpad(cast(id * 7919 % 50000 as string), 7, '0')) as code")
    rows.write.option("compression", "snappy").parquet(f"{tmp_path}/plain")
    write_table(rows, f"{tmp_path}/stored")
    plain, stored = (keys.stored_bytes(spark, f"{tmp_path}/{name}") for name in ("plain", "stored"))
    assert stored < 0.8 * plain


@pytest.mark.parametrize("column", ["n", "n % 3", "null"])
def test_a_result_read_once_is_numbered_without_staging_it_again(spark, monkeypatch, column):
    """Adaptive execution is free to merge small partitions here; the slices must stay apart."""
    source = spark.range(6000).selectExpr("id as n", "'x' as same").selectExpr(f"cast({column} as bigint) as c", "n")
    expected = numbered(dense_key(source, "key", ["c"], slices=8), "key")
    monkeypatch.setattr(keys, "stage", lambda df, label: pytest.fail("staged again"))
    for slices in (8, 1):
        found = dense_key(source, "key", ["c"], slices=slices, pinned=False)
        assert numbered(found, "key") == expected
        assert found.where("key > 5990").count() == 10
        assert found.agg(F.max("key")).first()[0] == 6000


def test_rows_are_dealt_without_their_hash_unless_a_value_fills_a_slice(spark, monkeypatch):
    dealt, deal = [], keys._with_slice
    monkeypatch.setattr(keys, "_with_slice", lambda *given: dealt.append(deal(*given)) or dealt[-1])
    for column in ("n", "n % 3"):
        dense_key(spark.range(6000).selectExpr(f"{column.replace('n', 'id')} as c", "id as n"), "key", ["c"], slices=8)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in dealt]
    assert ["xxhash64" in plan for plan in plans] == [False, True]
