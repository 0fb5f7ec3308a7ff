"""Every registered query on the smallest data, against its SQL where it has one."""

import pytest

import oracle
from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("key", list(queries()))
def test_query(spark, con, key):
    df = queries()[key](spark, SF)
    sql = oracle_sql().get(key)
    if sql is None:
        assert df.columns and not df.isEmpty()
    else:
        assert oracle.differences(df, con, sql) is None


def test_entry(spark):
    assert entry(spark).count() == 3


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
