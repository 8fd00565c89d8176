"""Every registered query against DuckDB on the test tables."""

import pytest
from conftest import DATA
from oracle import compare, connect

import __spark_entry__ as entry_point
import workloads

ORACLES = workloads.oracles()


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_every_query_has_an_oracle():
    assert set(workloads.registered()) == set(ORACLES)
    assert set(ORACLES) <= set(entry_point.oracle_sql()) and set(ORACLES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    problem, rows = compare(entry_point.queries()[name](spark, DATA), con, ORACLES[name])
    assert problem is None
    assert rows > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() == 1
