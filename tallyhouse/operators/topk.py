"""Top rows, with and without ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first `k` rows; `order` should end in a column that breaks ties."""
    return df.orderBy(*order).limit(k)


def top_k_with_ties(df: DataFrame, k: int, value: str, rank: str) -> DataFrame:
    """All rows whose rank by `value`, largest first, is at most `k`.

    The ranks follow from the `k` largest values alone, so no task ever sees the
    whole table and any number of tied rows stays spread out.
    """
    leaders = df.select(value).orderBy(F.col(value).desc()).limit(k)
    ranks = (
        leaders.select(
            F.col(value).alias("_value"),
            F.rank().over(Window.orderBy(F.col(value).desc())).alias(rank),
        )
        .distinct()
    )
    return df.join(
        F.broadcast(ranks), F.col(value).eqNullSafe(F.col("_value"))  # at most k rows
    ).drop("_value")
