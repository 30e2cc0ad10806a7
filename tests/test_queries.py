"""Every registered query next to its checking SQL."""

import pytest

import __spark_entry__ as registry
from compare import checker, compare

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return checker(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    rows, _, message = compare(spark, con, QUERIES[name], SQL.get(name), sf_dir)
    assert not message
    assert rows > 0


def test_registry_is_consistent(spark):
    assert set(SQL) <= set(QUERIES)
    assert registry.entry(spark).columns == ["compression", "file_count", "total_gb"]
