"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from compare import connect, differences
from tidemill.plans import registry

QUERIES, SQL = registry.queries(), registry.comparison_sql()


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name):
    result = QUERIES[name](spark, data)
    if name in SQL:
        assert differences(result, SQL[name], duck) is None
    else:
        assert result.count() > 0


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["o_orderkey", "status", "cents"]


def test_all_have_sql():
    assert set(QUERIES) == set(SQL)
