"""Fact-to-dimension aggregates that shrink the fact before it is joined."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize

_FIRST = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_AGAIN = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}

Measures = dict[str, tuple[str, str]]


def rollup_by(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    by: list[str],
    measures: Measures,
    fact_by: dict[str, Column] | None = None,
) -> DataFrame:
    """Aggregate `fact` by columns of a dimension (and expressions over the fact).

    Same result as fact LEFT JOIN dim GROUP BY, for sum, count, min and max. The
    fact is first reduced to one row per key, on the map side as far as it goes,
    so a key with any share of the rows weighs one row in the join. A fact without
    a dimension row falls under NULL. `measures`: output name to (function, column).
    """
    fact_by = fact_by or {}
    reduced = fact.groupBy(
        F.col(key).alias("_fact_key"), *[e.alias(n) for n, e in fact_by.items()]
    ).agg(*[_FIRST[f](c).alias(n) for n, (f, c) in measures.items()])
    members = dim.select(F.col(key).alias("_dim_key"), *by)
    return (
        reduced.join(members, F.col("_fact_key") == F.col("_dim_key"), "left")
        .groupBy(*fact_by, *by)
        .agg(*[_AGAIN[f](n).alias(n) for n, (f, _) in measures.items()])
    )


def measures_by_key(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    distinct: dict[str, str],
    measures: Measures | None = None,
    keys_resolved: bool = False,
) -> DataFrame:
    """One row per key: exact distinct counts (output name to column) and `measures`.

    The fact is grouped by (key, counted column) once for each count, so no row is
    copied and a key with any share of the rows is spread over all tasks; what is
    grouped is then counted per key. Keys that the dimension lacks (and NULL) make one
    row with a NULL key, unless `keys_resolved` says that there are none: they are
    found among the grouped keys, and only their groups are counted again.
    """
    measures = measures or {}
    groups = [
        fact.groupBy(key, column).agg(
            F.count("*").alias("_rows"), *[_FIRST[f](c).alias(n) for n, (f, c) in (measures if nth == 0 else {}).items()]
        )
        for nth, column in enumerate(distinct.values())
    ]
    again = [_AGAIN[f](n).alias(n) for n, (f, _) in measures.items()]
    names = [key, *distinct, *measures]

    per_key = None
    for nth, (name, column) in enumerate(distinct.items()):
        counted = groups[nth].groupBy(key).agg(F.count(column).alias(name), *(again if nth == 0 else []))
        if per_key is None:
            per_key = counted
        else:
            counted = counted.withColumnRenamed(key, "_key")
            per_key = per_key.join(counted, F.col(key).eqNullSafe(F.col("_key")))
    per_key = per_key.select(*names)
    if keys_resolved:
        return per_key

    # written: read three times, and the joins with few lost keys need no shuffle of the fact
    per_key = materialize(per_key)
    members = dim.select(key)
    lost = materialize(per_key.join(members, key, "left_anti").select(F.col(key).alias("_key")))
    rows = []
    for nth, (name, column) in enumerate(distinct.items()):
        theirs = groups[nth].join(lost, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
        rows.append(theirs.agg(F.countDistinct(column).alias(name), F.sum("_rows").alias("_rows"), *(again if nth == 0 else [])))
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    orphans = together.agg(F.max("_rows").alias("_rows"), *[F.max(n).alias(n) for n in names[1:]]).where("_rows > 0")
    no_key = F.lit(None).cast(fact.schema[key].dataType).alias(key)
    return per_key.join(members, key, "left_semi").unionByName(orphans.select(no_key, *names[1:]))


def attach(totals: DataFrame, dim: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Add dimension columns to rows that already hold one row per key."""
    members = dim.select(F.col(key).alias("_dim_key"), *columns)
    return totals.join(members, F.col(key) == F.col("_dim_key"), "left").drop("_dim_key")


def with_share(df: DataFrame, value: str, total: str, share: str, digits: int = 2) -> DataFrame:
    """Add the overall sum of `value` and each row's percentage of it."""
    overall = df.agg(F.sum(value)).scalar()
    part = F.col(value).cast("double") / F.col(total).cast("double") * 100
    return df.withColumn(total, overall).withColumn(share, F.round(part, digits))
