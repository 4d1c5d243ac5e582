"""Every query with SQL gives in Spark what DuckDB gives, on the smallest tables; all others run."""

import datetime
import decimal
import math

import pytest

import __spark_entry__ as entry_module

LLM = entry_module.llm.QUERIES if entry_module.llm else {}  # these are tested with their subpackage
QUERIES = {k: v for k, v in entry_module.queries().items() if k not in LLM}
SQL = {k: v for k, v in entry_module.oracle_sql().items() if k not in LLM}


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def test_sql_is_for_queries():
    assert set(SQL) <= set(QUERIES)


def check_against_sql(df, duck, sql):
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = duck.execute(sql)
    have = [c[0] for c in res.description]
    assert sorted(have) == cols
    at = [have.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in res.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, data, duck, name):
    check_against_sql(QUERIES[name](spark, data), duck, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, data, name):
    assert QUERIES[name](spark, data).count() >= 0


def test_entry(spark, data):
    df = entry_module.entry(spark)
    assert df.columns == ["volume", "keep", "first", "drop", "repair", "chars"]
    assert df.count() > 0
