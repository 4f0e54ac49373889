"""Merges without an in-place table: missing rows and conditional upserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import any_of, differs
from .rows import require_unique

ACTION = "merge_action"
KEEP, UPDATE, INSERT = "keep", "update", "insert"


def missing_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `source` whose key `target` lacks."""
    return source.join(target.select(*keys), keys, "left_anti")


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    return target.unionByName(missing_rows(target, source, keys))


def _pair(target: DataFrame, source: DataFrame, keys: list[str], how: str) -> DataFrame:
    same = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    return source.alias("s").join(target.alias("t"), same, how)


def _changed(compare: list[str]) -> Column:
    return any_of([differs(F.col(f"t.{c}"), F.col(f"s.{c}")) for c in compare])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    compare: list[str],
    set_cols: list[str],
) -> DataFrame:
    """The whole target after a merge, with `merge_action` per row.

    A matched row takes `set_cols` from the source when a `compare` column
    differs; a new key is inserted; rows the source lacks stay.
    """
    fresh = require_unique(source, keys, "merge source")
    joined = _pair(target, fresh, keys, "full_outer")
    in_target, in_source = F.col(f"t.{keys[0]}").isNotNull(), F.col(f"s.{keys[0]}").isNotNull()
    action = (
        F.when(~in_target, INSERT)
        .when(in_source & _changed(compare), UPDATE)
        .otherwise(KEEP)
    )
    decided = joined.withColumn(ACTION, action)
    out = [
        F.when(
            F.col(ACTION).isin(INSERT, UPDATE) if c in set_cols else F.col(ACTION) == INSERT,
            F.col(f"s.{c}"),
        )
        .otherwise(F.col(f"t.{c}"))
        .alias(c)
        for c in target.columns
    ]
    return decided.select(*out, ACTION)


def merge_delta(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    compare: list[str],
    set_cols: list[str],
    old: dict[str, Column],
) -> DataFrame:
    """Only the rows a merge inserts or updates, in their new form.

    `old` names expressions over the replaced target row (NULL for an insert),
    such as the partition it has to leave. Target rows without a source row take
    no part, so of the target only keys and compared columns are shuffled, plus
    what is neither compared nor set.
    """
    fresh = require_unique(source, keys, "merge source")
    kept = [c for c in target.columns if c not in set_cols and c not in keys]
    before = target.select(*[e.alias(n) for n, e in old.items()], *dict.fromkeys([*keys, *compare, *kept]))
    joined = _pair(before, fresh, keys, "left")
    found = F.col(f"t.{keys[0]}").isNotNull()
    action = F.when(~found, INSERT).when(_changed(compare), UPDATE)
    out = [
        F.when(found, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c)
        if c in kept
        else F.col(f"s.{c}")
        for c in target.columns
    ]
    return joined.select(*out, *[F.col(f"t.{n}") for n in old], action.alias(ACTION)).filter(
        F.col(ACTION).isNotNull()
    )
