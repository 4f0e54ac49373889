"""Warehouse checks: row counts, log tail, orphans, history and key faults."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators.checks import broken_periods, missing_values, orphan_keys, repeated_keys
from ..operators.topk import top_k
from .gold import LINE


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counted = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("tbl"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def log_tail(log: DataFrame, k: int = 20) -> DataFrame:
    return top_k(log, k, F.col("log_id").desc())


def unresolved_customers(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Number of fact rows without a customer, those with no key included."""
    held = fact.groupBy("customer_key").agg(F.count("*").alias("n"))
    lost = held.join(customers.select("customer_key"), "customer_key", "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("unresolved_customers"))


def current_not_unique(dim: DataFrame, business_key: str) -> DataFrame:
    """Members with more than one open version."""
    return repeated_keys(dim.filter("scd_is_current"), [business_key], "cnt")


def primary_key_faults(tables: dict[str, DataFrame]) -> DataFrame:
    """Repeated primary keys of the gold tables: table, key as text, rows.

    A fact without line numbers is checked for repeated products in an order.
    """
    found = []
    for name, df in tables.items():
        keys = [k for k in schemas.PRIMARY_KEYS[name] if k != LINE or k in df.columns]
        text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
        found.append(
            repeated_keys(df, keys).select(
                F.lit(name).alias("table_name"), text.alias("key_text"), "row_count"
            )
        )
    return reduce(DataFrame.unionByName, found)


def foreign_key_faults(tables: dict[str, DataFrame]) -> DataFrame:
    """Values of the declared references that the parent lacks.

    A reference that cannot be checked, as a table or column of it is missing, is a
    fault of its own: one row with NULL for key and rows.
    """
    spark = next(iter(tables.values())).sparkSession
    found, absent = [], []
    for child, column, parent, key in schemas.FOREIGN_KEYS:
        if column not in _columns(tables, child) or key not in _columns(tables, parent):
            absent.append((child, column, None, None))
            continue
        found.append(
            orphan_keys(tables[child], column, tables[parent], key).select(
                F.lit(child).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.col(column).cast("string").alias("key_text"),
                "row_count",
            )
        )
    kind = "table_name string, column_name string, key_text string, row_count bigint"
    return reduce(DataFrame.unionByName, found, spark.createDataFrame(absent, kind))


def _columns(tables: dict[str, DataFrame], name: str) -> list[str]:
    return tables[name].columns if name in tables else []


def not_null_faults(tables: dict[str, DataFrame]) -> DataFrame:
    """NULLs in required columns; `null_rows` is NULL for a column the table lacks."""
    spark = next(iter(tables.values())).sparkSession
    found, absent = [], []
    for name, df in tables.items():
        carried = [c for c in schemas.REQUIRED[name] if c in df.columns]
        absent += [(name, c, None) for c in schemas.REQUIRED[name] if c not in carried]
        if carried:
            faults = missing_values(df, carried).filter("null_rows > 0")
            found.append(faults.select(F.lit(name).alias("table_name"), "column_name", "null_rows"))
    kind = "table_name string, column_name string, null_rows bigint"
    return reduce(DataFrame.unionByName, found, spark.createDataFrame(absent, kind))


def period_faults(dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Dimension versions with impossible periods; name to (table, key column)."""
    found = [
        broken_periods(df, key).select(
            F.lit(name).alias("table_name"),
            F.col(key).alias("version_key"),
            "scd_start_date",
            "scd_end_date",
            "scd_is_current",
        )
        for name, (df, key) in dims.items()
    ]
    return reduce(DataFrame.unionByName, found)
