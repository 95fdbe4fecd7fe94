"""Every registered query against its SQL, on the smallest tables."""

import compare
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
