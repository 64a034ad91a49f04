"""Every registered query against its SQL form on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, name):
    result = entry.queries()[name](spark, SF)
    if name in SQL:
        assert compare(result, duck, SQL[name]) == []
    else:
        assert result.count() > 0


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["claimNumber", "predictedProbability", "predictedValue"]
    assert result.count() > 0


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(entry.queries())
