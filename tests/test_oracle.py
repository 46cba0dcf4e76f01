"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from compare import compare, duck_connect
from conftest import SF_SMALL
from hirebook.plans.catalog import QUERIES
from hirebook.plans.oracle import oracle_sql

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["ep_id", "ep_name", "Revenue", "StdCost", "GrossProfit"]
    assert df.count() > 0


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_types_match_oracle(spark, con, name):
    s = dict(QUERIES[name](spark, SF_SMALL).dtypes)
    rel = con.sql(ORACLE[name])
    d = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {k: SPARK_TO_DUCK.get(v) for k, v in s.items()} == d
