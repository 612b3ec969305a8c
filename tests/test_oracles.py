"""Every registered query against the same SQL in DuckDB, over whole tables."""

import os

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from tallybook.plans.oracles import SQL
from tallybook.plans.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert contract.entry(spark).count() == 150


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    rows, problems = compare(contract.queries()[name](spark, SF_DIR), con, contract.oracle_sql()[name])
    assert not problems
    assert rows > 0
