from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from lamina.operators.dimensions import catalog_dim, resolve_parent, snapshot_dim, versioned_dim
from lamina.operators.lookups import lookup
from lamina.operators.marts import trend, with_flags
from lamina.operators.metrics import Factor, entity_metrics, factors_long, factors_wide
from lamina.operators.signals import Rule, unify


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(
        [(1, "a", True), (2, "b", False), (3, "b", True), (4, None, True)],
        "id bigint, code string, is_current_flag boolean",
    )


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([(10, "a"), (11, "b"), (12, "x"), (13, None)], "n int, code string")


def test_lookup_keeps_orphans_and_never_matches_null(facts, dim):
    found = lookup(facts, dim, {"code": "code"}, {"dim_id": "id"}, current=True)
    assert found.columns == ["n", "code", "dim_id"]
    assert rows(found) == [(10, "a", 1), (11, "b", 3), (12, "x", None), (13, None, None)]


def test_lookup_multiplies_rows_of_a_repeated_key(facts, dim):
    found = lookup(facts, dim, {"code": "code"}, {"dim_id": "id"})
    assert [r for r in rows(found) if r[0] == 11] == [(11, "b", 2), (11, "b", 3)]


def test_lookup_drops_orphans(facts, dim):
    found = lookup(facts, dim, {"code": "code"}, {"dim_id": "id"}, current=True, orphans="drop")
    assert rows(found) == [(10, "a", 1), (11, "b", 3)]


def test_lookup_fails_on_orphans(facts, dim):
    found = lookup(facts, dim, {"code": "code"}, {"dim_id": "id"}, current=True, orphans="fail")
    with pytest.raises(PySparkException, match="no dim_id"):
        found.collect()
    known = facts.where("code in ('a', 'b')")
    checked = lookup(known, dim, {"code": "code"}, {"dim_id": "id"}, current=True, orphans="fail")
    assert rows(checked) == [(10, "a", 1), (11, "b", 3)]


def test_lookup_refuses_unknown_policies(facts, dim):
    with pytest.raises(ValueError, match="orphans"):
        lookup(facts, dim, {"code": "code"}, {"dim_id": "id"}, orphans="ignore")


def test_lookup_on_two_keys(spark):
    facts = spark.createDataFrame([(1, "s", "r"), (2, "s", "q")], "n int, a string, b string")
    dim = spark.createDataFrame([(7, "s", "r"), (8, "t", "r")], "id bigint, x string, y string")
    assert rows(lookup(facts, dim, {"a": "x", "b": "y"}, {"dim_id": "id"})) == [
        (1, "s", "r", 7),
        (2, "s", "q", None),
    ]


def test_lookup_on_a_cast_key(spark):
    facts = spark.createDataFrame([(1, 70), (2, 71)], "n int, account bigint")
    dim = spark.createDataFrame([(5, "70")], "id bigint, account_text string")
    on = {"cast(account as string)": "account_text"}
    assert rows(lookup(facts, dim, on, {"dim_id": "id"})) == [(1, 70, 5), (2, 71, None)]


def test_hot_key_is_split_in_a_large_lookup(spark, confs):
    confs(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__coalescePartitions__enabled="false",
        # With only 8 partitions a third of the rows is no more than a few times the median.
        adaptive__skewJoin__skewedPartitionFactor="1.2",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="2000",
        adaptive__advisoryPartitionSizeInBytes="2000",
    )
    facts = spark.range(0, 60000, 1, 8).selectExpr(
        "id as n", "if(id % 3 = 0, 'hot', concat('k', id % 500)) as code"
    )
    dim = spark.range(500).selectExpr("id", "if(id = 0, 'hot', concat('k', id)) as code")
    found = lookup(facts, dim, {"code": "code"}, {"dim_id": "id"})
    found.collect()
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    assert found.where("code = 'hot'").agg({"dim_id": "max"}).first()[0] == 0


def test_versioned_dim_drops_copies_and_marks_the_open_version(spark):
    raw = spark.createDataFrame(
        [
            ("e1", "d", date(2024, 1, 1), None),
            ("e2", "d", date(2023, 1, 1), date(2023, 12, 31)),
            ("e3", "d", date(2023, 1, 1), date(2023, 12, 31)),
        ],
        "event string, code string, f date, t date",
    )
    dim = versioned_dim(raw, {"code": "code", "f": "f", "t": "t"}, end="t")
    assert rows(dim) == [
        ("d", date(2023, 1, 1), date(2023, 12, 31), False),
        ("d", date(2024, 1, 1), None, True),
    ]


def test_snapshot_dim_is_always_current(spark):
    raw = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "code string, n int")
    assert rows(snapshot_dim(raw, {"code": "code"})) == [
        ("a", None, True),
        ("b", None, True),
    ]


def test_catalog_takes_the_greatest_value_and_groups_null_codes(spark):
    one = spark.createDataFrame([("a", "x"), (None, "n")], "code string, name string")
    two = spark.createDataFrame([("y", "a"), ("z", "b")], "name string, code string")
    assert rows(catalog_dim([one, two], ["code"], "label")) == [
        ("a", "y", "label"),
        ("b", "z", "label"),
        (None, "n", "label"),
    ]


@pytest.mark.parametrize(("current_only", "parent"), [(True, 3), (False, 1)])
def test_parent_is_the_smallest_matching_record(spark, current_only, parent):
    dim = spark.createDataFrame(
        [(1, "p", None, False), (3, "p", None, True), (4, "c", "p", True), (5, "d", "x", True)],
        "id bigint, code string, parent_code string, is_current_flag boolean",
    )
    found = resolve_parent(dim, "id", "code", "parent_code", "parent_id", current_only)
    assert {r["id"]: r["parent_id"] for r in found.collect()} == {1: None, 3: None, 4: parent, 5: None}


def test_unify_filters_before_tagging_and_maps_by_name(spark):
    raw = {
        "one": spark.createDataFrame([("a", "Y"), ("b", "N"), ("c", None)], "k string, flag string"),
        "two": spark.createDataFrame([("d", 5)], "key string, v int"),
    }
    rules = [
        Rule("one", {"source": "'one'", "code": "k"}, where="flag != 'N'"),
        Rule("two", {"code": "key", "source": "'two'"}),
    ]
    events = unify(rules, raw.__getitem__)
    assert rows(events.select("source", "code")) == [("one", "a"), ("two", "d")]


def test_entity_metrics_are_zero_without_activity(spark):
    base = spark.createDataFrame([(1, "x"), (2, "y")], "employee_id bigint, note string")
    activity = spark.createDataFrame(
        [(1, Decimal("2.50")), (1, None), (None, Decimal("9.00"))],
        "employee_id bigint, amount decimal(18,2)",
    )
    metrics = {"n": "count(*)", "total": "sum(amount)", "large": "count_if(amount > 5)"}
    assert rows(entity_metrics(base, "employee_id", [(activity, metrics)])) == [
        (1, "x", 2, Decimal("2.50"), 0),
        (2, "y", 0, Decimal("0.00"), 0),
    ]


def test_factors_there_and_back(spark):
    events = spark.createDataFrame(
        [(1, "OPEN", "ib"), (1, "OPEN", "x"), (2, "CLOSED", "x"), (None, "OPEN", "ib")],
        "e bigint, status string, domain string",
    )
    factors = [
        Factor("OPEN_CNT", "open", "all", "status = 'OPEN'"),
        Factor("IB_CNT", "ib", "ib", "domain = 'ib'"),
    ]
    long = factors_long(events, "e", factors)
    assert rows(long.select("e", "risk_factor_code", "factor_value_num")) == [
        (1, "IB_CNT", Decimal("1.0000")),
        (1, "OPEN_CNT", Decimal("2.0000")),
        (None, "IB_CNT", Decimal("1.0000")),
        (None, "OPEN_CNT", Decimal("1.0000")),
    ]
    wide = factors_wide(long.where("e is not null"), "e", {"OPEN_CNT": "opened", "IB_CNT": "ib"})
    assert rows(wide) == [(1, 2, 1)]


def test_trend_starts_empty_per_entity(spark):
    scores = spark.createDataFrame(
        [(1, date(2024, 2, 1), 7), (1, date(2024, 1, 1), 5), (2, date(2024, 1, 1), 1)],
        "e bigint, d date, v int",
    )
    found = trend(scores, "e", "d", "v", "before", "delta")
    assert found._jdf.queryExecution().executedPlan().toString().count("Window [") == 1
    assert rows(found) == [
        (1, date(2024, 1, 1), 5, None, None),
        (1, date(2024, 2, 1), 7, 5, 2),
        (2, date(2024, 1, 1), 1, None, None),
    ]


def test_flags_treat_null_as_false(spark):
    counts = spark.createDataFrame([(1,), (0,), (None,)], "n int")
    assert [r["f"] for r in with_flags(counts, {"f": "n"}).collect()] == [True, False, False]
