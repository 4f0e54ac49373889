"""Session settings for local runs and tests; a cluster brings its own session."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*",
    memory: str = "8g",
    app: str = "tallyhouse",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    parallel = "8" if cores == "*" else str(max(int(cores), 1))
    settings = {
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": parallel,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **(conf or {}),
    }
    # one machine, so a folder of its own is shared by all of the session
    settings.setdefault("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tallyhouse-"))
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
