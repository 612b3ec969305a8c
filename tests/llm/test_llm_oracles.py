"""Queries against SQL, and the contract's names."""

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from tallybook.llm.oracles import SQL
from tallybook.llm.queries import QUERIES


def test_all_are_registered():
    names = contract.queries()
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf, name):
    rows, problems = compare(QUERIES[name](spark, sf), connect(sf), SQL[name])
    assert not problems
    assert rows > 0
