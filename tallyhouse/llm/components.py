"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.sources.scratch import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, a, 7))")).first()
    )


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours to the least one it knows."""
    if small:
        around = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    linked = around.join(least, "u")
    if small:
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    else:
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b); the root is the least node reachable.

    Every node ends as a leaf of a star around its root. Each step is written to
    the shared folder, which cuts the plan and survives lost executors. A node
    with very many links is split by Spark's skew handling of the join.
    """
    now = materialize(edges.where(F.col("a") != F.col("b")).distinct())
    state = _state(now)
    while True:
        now = materialize(_star(_star(now, small=False), small=True))
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
