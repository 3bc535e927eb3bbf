"""Every registered query against DuckDB on the smallest data set."""

import pytest
from oracle import compare, connect

from millrace.workload import registry

SF = "/root/testdata/sf0.001"
QUERIES = registry()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    query, sql = QUERIES[name]
    assert compare(spark, SF, query, sql, con) == []


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
