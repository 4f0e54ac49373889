"""Full-history (SCD type 2) dimensions.

A dimension holds every version of a member; the open one has
`scd_is_current` set and no end date. One join of the open versions with the
staged members settles all of keep, expire and insert.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import any_of, differs
from .keys import assign_keys
from .rows import require_unique

ACTION = "scd_action"
KEEP, EXPIRE, INSERT = "keep", "expire", "insert"


def scd2_changes(
    current: DataFrame,
    stage: DataFrame,
    business_key: str,
    tracked: list[str],
    surrogate_key: str,
    as_of: dt.date,
    now: dt.datetime,
    expire_missing: bool = False,
) -> DataFrame:
    """What becomes of the open versions: one row per version, with `scd_action`.

    A member whose tracked columns changed yields two rows, the version that
    ends the day before `as_of` and the one that starts then. New versions carry
    no surrogate key yet. The stage must hold each member once.
    """
    columns = current.columns
    types = {f.name: f.dataType for f in current.schema.fields}
    staged = require_unique(stage, [business_key], "stage")
    joined = current.alias("d").join(
        staged.alias("s"), F.col(f"d.{business_key}") == F.col(f"s.{business_key}"), "full_outer"
    )
    in_dim = F.col(f"d.{business_key}").isNotNull()
    in_stage = F.col(f"s.{business_key}").isNotNull()
    changed = in_dim & in_stage & any_of(
        [differs(F.col(f"d.{c}"), F.col(f"s.{c}").cast(types[c])) for c in tracked]
    )
    gone = in_dim & ~in_stage if expire_missing else F.lit(False)
    ends, starts = changed | gone, changed | ~in_dim

    closing = {
        "scd_end_date": F.lit(as_of - dt.timedelta(days=1)),
        "scd_is_current": F.lit(False),
        "dw_update_date": F.lit(now),
    }
    opening = {
        surrogate_key: F.lit(None),
        "scd_start_date": F.lit(as_of),
        "scd_end_date": F.lit(None),
        "scd_is_current": F.lit(True),
        "dw_insert_date": F.lit(now),
        "dw_update_date": F.lit(None),
    }
    old = F.struct(
        *[
            F.when(ends, closing[c]).otherwise(F.col(f"d.{c}")).cast(types[c]).alias(c)
            if c in closing
            else F.col(f"d.{c}").alias(c)
            for c in columns
        ],
        F.when(ends, EXPIRE).otherwise(KEEP).alias(ACTION),
    )
    new = F.struct(
        *[opening.get(c, F.col(f"s.{c}")).cast(types[c]).alias(c) for c in columns],
        F.lit(INSERT).alias(ACTION),
    )
    versions = F.array_compact(F.array(F.when(in_dim, old), F.when(starts, new)))
    return joined.select(F.inline(versions))


def scd2_apply(
    dim: DataFrame,
    stage: DataFrame,
    business_key: str,
    tracked: list[str],
    surrogate_key: str,
    as_of: dt.date,
    now: dt.datetime,
    expire_missing: bool = False,
) -> DataFrame:
    """The whole dimension after a load, with keys and `scd_action`."""
    changes = scd2_changes(
        dim.filter("scd_is_current"),
        stage,
        business_key,
        tracked,
        surrogate_key,
        as_of,
        now,
        expire_missing,
    )
    last_key = dim.agg(F.coalesce(F.max(surrogate_key), F.lit(0))).scalar()
    added = assign_keys(
        changes.filter(F.col(ACTION) == INSERT), surrogate_key, [business_key], last_key
    )
    past = dim.filter(~F.col("scd_is_current")).withColumn(ACTION, F.lit(KEEP))
    return past.unionByName(changes.filter(F.col(ACTION) != INSERT)).unionByName(added)


def action_counts(changes: DataFrame, column: str = ACTION) -> dict[str, int]:
    return {r[0]: r[1] for r in changes.groupBy(column).count().collect()}
