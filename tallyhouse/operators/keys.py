"""Surrogate keys without a global sort of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .rows import join_side

#: `monotonically_increasing_id` counts the rows of a partition in its low 33 bits.
LOW_BITS = 33


def assign_keys(df: DataFrame, name: str, by: list[str], after: int | Column = 0) -> DataFrame:
    """Fill `name` with dense keys `after`+1, `after`+2, … along the order of `by`.

    `by` must identify a row. Only its columns are dealt into ranges, sorted and
    counted there; a range starts where the sizes of the ranges before it end, one
    row for each shuffle partition. The numbered `by` is written once, as ranges must
    not change between readers, and meets the rows in one join.
    """
    sorted_keys = df.select(*by).repartitionByRange(*by).sortWithinPartitions(*by)
    at = F.monotonically_increasing_id()
    placed = sorted_keys.select(F.struct(*by).alias("_by"), at.alias("_at"))
    dealt = materialize(
        placed.select(
            "_by",
            F.shiftright("_at", LOW_BITS).alias("_range"),
            F.col("_at").bitwiseAND(F.lit((1 << LOW_BITS) - 1)).alias("_nth"),
        )
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("_range")
        .agg(F.count("*").alias("_size"))
        .select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    base = F.lit(after) if isinstance(after, int) else after
    number = (base + F.col("_start") + F.col("_nth") + 1).cast("long").alias("_number")
    numbered = dealt.join(F.broadcast(starts), "_range").select("_by", number)  # one row per range
    rows = join_side(df, dealt.count()).withColumn("_by", F.struct(*by)).join(numbered, "_by")
    return rows.withColumn(name, F.col("_number")).select(*dict.fromkeys([*df.columns, name]))
