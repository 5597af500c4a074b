from __future__ import annotations

import pytest

import __spark_entry__ as contract
from conftest import SMALL
from landfall import workloads
from tools.check_oracle import compare, open_tables

# Corpus queries have tests of their own.
QUERIES, SQL = workloads.queries(), workloads.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return open_tables(SMALL)


def test_entry_has_rows(spark):
    fact = contract.entry(spark)
    assert fact.columns[0] == "year"
    assert fact.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_its_sql(spark, tables, name):
    assert compare(tables, SQL[name], QUERIES[name](spark, SMALL)) is None
