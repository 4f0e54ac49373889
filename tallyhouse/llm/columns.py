"""Input columns whose names an operator uses itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def set_aside(docs: DataFrame, names: list[str]) -> tuple[DataFrame, list[Column]]:
    """docs with the columns of these names renamed, and the columns that give docs back.

    Names are compared without case, as Spark resolves them.
    """
    used = {n.lower() for n in names}
    known = {c.lower() for c in docs.columns} | used
    renamed: dict[str, str] = {}
    for column in docs.columns:
        if column.lower() in used:
            new = f"input_{column}"
            while new.lower() in known:
                new = f"input_{new}"
            known.add(new.lower())
            renamed[column] = new
    back = [F.col(f"`{renamed.get(c, c)}`").alias(c) for c in docs.columns]
    return docs.withColumnsRenamed(renamed), back
