"""Intermediate tables that are read more than once.

They are written as parquet to the folder the cluster shares, so a lost
executor never recomputes a different answer and readers prune columns.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR = "spark.checkpoint.dir"


@cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix="tallyhouse-")


def scratch_dir(spark: SparkSession, slot: str | None = None) -> str:
    """A folder below `spark.checkpoint.dir`: a fresh one, or the one of a slot.

    Without that setting, the warehouse of the session is the folder all executors
    share; a session whose executor is the driver itself has a temporary folder.
    """
    base = spark.conf.get(SHARED_DIR, None)
    if not base and re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        base = _local_dir(spark.sparkContext.applicationId)
    elif not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/{slot or uuid.uuid4().hex}"


def materialize(df: DataFrame, slot: str | None = None, compression: str | None = None) -> DataFrame:
    """Write `df` once and return it as a table to be read many times.

    A slot is overwritten by its next use, so repeated loads leave one copy.
    """
    folder = scratch_dir(df.sparkSession, slot)
    writer = df.write.mode("overwrite")
    (writer.option("compression", compression) if compression else writer).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
