"""Operators with SQL against DuckDB over the driver's tables."""

import duckdb
import pytest

from tallyhouse.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_rows(spark, sf_dir, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got = QUERIES[name](spark, sf_dir)
    result = con.execute(ORACLES[name])
    assert [c[0] for c in result.description] == got.columns
    assert sorted(map(tuple, result.fetchall())) == sorted(map(tuple, got.collect()))


def test_every_numbered_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
