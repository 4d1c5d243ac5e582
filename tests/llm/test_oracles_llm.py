"""Queries of the operators for training data against their SQL, on the smallest tables; all others run."""

import pytest

import __spark_entry__ as entry_module
from scriptorium.llm import queries
from tests.test_oracles import check_against_sql

QUERIES = {k: v for k, v in entry_module.queries().items() if k in queries.QUERIES}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, data, duck, name):
    check_against_sql(QUERIES[name](spark, data), duck, queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(queries.SQL)))
def test_runs(spark, data, name):
    assert QUERIES[name](spark, data).count() >= 0
