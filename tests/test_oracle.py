"""Every registered query against its SQL, value by value."""

from __future__ import annotations

import importlib

import pytest

from testbed.compare import connect, difference
from testbed.queries import QUERIES

contract = importlib.import_module("__spark_entry__")


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = connect(sf_dir)
    yield con
    con.close()


def test_every_query_has_its_sql():
    assert QUERIES.keys() <= contract.queries().keys() & contract.oracle_sql().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() == 150


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_oracle(spark, sf_dir, oracle, key):
    sql = contract.oracle_sql()[key]
    assert difference(contract.queries()[key](spark, sf_dir), oracle, sql) is None
