"""Every registered query equals its SQL on the given tables."""

import pytest
from check import compare, duck
from conftest import SMALL

import __spark_entry__ as entry

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_equals_sql(spark, connection, name):
    result = entry.queries()[name](spark, SMALL)
    if name in ORACLE:
        assert compare(name, result, connection, ORACLE[name]) == []
    else:
        assert result.count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
