"""Checks that stand in for declared constraints. No rows back means no fault."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def repeated_keys(df: DataFrame, keys: list[str], name: str = "row_count") -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).filter(F.col(name) > 1)


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Values of `column` the parent lacks, with the child rows that hold them.

    Child rows are counted per value before they meet the parent. A NULL is not
    an orphan of a declared reference.
    """
    held = child.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count("*").alias("row_count")
    )
    known = parent.select(F.col(parent_key).alias(column))
    return held.join(known, column, "left_anti")


def missing_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column with the number of NULLs in it, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in columns]
    return counts.select(F.inline(F.array(*pairs)))


def broken_periods(dim: DataFrame, key: str) -> DataFrame:
    """Versions that end before they start, or are open yet ended."""
    wrong_way = F.col("scd_end_date") < F.col("scd_start_date")
    open_but_ended = F.col("scd_is_current") & F.col("scd_end_date").isNotNull()
    return dim.filter(wrong_way | open_but_ended).select(
        key, "scd_start_date", "scd_end_date", "scd_is_current"
    )
