"""Text and number expressions: code maps, blanks, guarded divisions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "n/a"


def map_codes(code: Column, labels: dict[str, str], default: str = UNKNOWN) -> Column:
    """Label of a code, ignoring case and outer blanks; `default` for the rest."""
    clean = F.upper(F.trim(code))
    first, *rest = labels.items()
    branches = reduce(
        lambda acc, kv: acc.when(clean == kv[0], kv[1]), rest, F.when(clean == first[0], first[1])
    )
    return branches.otherwise(default)


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def unknown_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(UNKNOWN))


def full_name(first: Column, last: Column) -> Column:
    """Names joined by one blank, a missing one counting as empty."""
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))


def int_div(a: str, b: str) -> Column:
    """Integer quotient of two columns cut towards zero; NULL when `b` is 0 or no INT holds it."""
    return F.expr(f"TRY_CAST(CAST({a} AS BIGINT) DIV nullif({b}, 0) AS INT)")


def ratio(top: Column, bottom: Column) -> Column:
    """One IEEE division, NULL when the divisor is 0."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def mean(value: Column) -> Column:
    """Aggregate mean as exact sum over count, divided once."""
    return ratio(F.sum(value), F.count(value))


def differs(a: Column, b: Column) -> Column:
    """True when the values differ, NULL being equal to NULL only."""
    return ~a.eqNullSafe(b)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
