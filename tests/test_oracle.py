import pytest

import __spark_entry__ as entry

from oracle_check import connect, difference

OPTIONAL, _ = entry.optional_parts()
QUERIES = {key: query for key, query in entry.queries().items() if key not in OPTIONAL}
SQL = {key: sql for key, sql in entry.oracle_sql().items() if key not in OPTIONAL}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("key", list(QUERIES))
def test_same_rows_as_duckdb(spark, duck, sf_dir, key):
    assert difference(QUERIES[key](spark, sf_dir), duck, SQL[key]) is None


def test_entry(spark, sf_dir):
    assert entry.entry(spark).columns == ["category", "total_revenue"]
