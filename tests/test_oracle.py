"""Every registered query against its SQL counterpart, on the smallest scale."""

import oracle
import pytest

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connection(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, FOLDER)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert oracle.compare(df, con, sql) == []


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 42


def test_sql_names_are_registered():
    assert set(oracle_sql()) <= set(queries())
