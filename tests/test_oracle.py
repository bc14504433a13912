"""Every registered query with SQL equals DuckDB, on the smallest tables."""

import pytest

from riskloom.catalog import ORACLES, QUERIES
from tests.oracle import connect, differences

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, DIRECTORY)
    assert differences(df, con, ORACLES[name]) == []


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
