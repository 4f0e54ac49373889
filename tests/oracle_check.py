"""Run registered queries in Spark and their SQL in DuckDB and compare all values."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple((type(r[i]).__name__, repr(r[i])) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides hold the same rows, else a short account."""
    columns, left = canonical(spark_df.columns, spark_df.collect())
    found = con.execute(sql)
    names, right = canonical([d[0] for d in found.description], found.fetchall())
    if columns != names:
        return f"columns {columns} and {names}"
    if left != right:
        only = [r for r in left if r not in set(right)][:2], [r for r in right if r not in set(left)][:2]
        return f"{len(left)} and {len(right)} rows; only in Spark {only[0]}; only in DuckDB {only[1]}"
    return None


def main(sf_dir: str, keys: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from tallyhouse.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql = connect(sf_dir), entry.queries(), entry.oracle_sql()
    faults = 0
    for key in keys or queries:
        fault = difference(queries[key](spark, sf_dir), con, sql[key])
        faults += fault is not None
        print(f"\n{key}: {fault or 'same'}", flush=True)
    print(f"\n{faults} differ")
    return faults


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
