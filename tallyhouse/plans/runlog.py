"""Run log: one appended row per load step, failures included."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import GOLD
from ..sources.snapshots import empty_table
from ..sources.versions import path_exists

SCHEMA = GOLD["dw_load_log"]

Work = Callable[[], "Outcome"]


@dataclass
class Outcome:
    """Exact row counts of one step."""

    inserted: int = 0
    updated: int = 0
    expired: int = 0
    message: str | None = None


@dataclass
class Attempt:
    name: str
    start: dt.datetime
    end: dt.datetime
    outcome: Outcome
    error: Exception | None = None


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


class RunLog:
    """An append-only table; `clock` stamps the steps."""

    def __init__(self, spark: SparkSession, folder: str, clock: Callable[[], dt.datetime] = utc_now):
        self.spark, self.folder, self.clock = spark, folder, clock

    def read(self) -> DataFrame:
        if not path_exists(self.spark, self.folder):
            return empty_table(self.spark, SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.folder)

    def register(self, name: str) -> None:
        """A view of the log; its files are listed at each reading."""
        columns = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in SCHEMA.fields)
        if not path_exists(self.spark, self.folder):
            empty_table(self.spark, SCHEMA).write.parquet(self.folder)
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{self.folder}`")

    def run(self, steps: dict[str, Work]) -> list[Outcome]:
        """Run steps that do not depend on each other side by side, then log them in order.

        A failure lets the others finish; it is logged and then raised.
        """
        with ThreadPoolExecutor(len(steps)) as pool:
            attempts = list(pool.map(lambda step: self._attempt(*step), steps.items()))
        self._append(attempts)
        for attempt in attempts:
            if attempt.error is not None:
                raise attempt.error
        return [attempt.outcome for attempt in attempts]

    def _attempt(self, name: str, work: Work) -> Attempt:
        start = self.clock()
        try:
            outcome, error = work(), None
        except Exception as failure:
            outcome, error = Outcome(message=str(failure)), failure
        return Attempt(name, start, self.clock(), outcome, error)

    def _append(self, attempts: list[Attempt]) -> None:
        logged = self.read().count()
        rows = []
        for log_id, a in enumerate(attempts, logged + 1):
            done, status = a.outcome, "FAILED" if a.error else "SUCCESS"
            counts = (done.inserted, done.updated, done.expired)
            values = (log_id, a.name, a.start, a.end, *counts, status, done.message)
            typed = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, SCHEMA.fields)]
            rows.append(F.struct(*typed))
        frame = self.spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))
        frame.write.mode("append").parquet(self.folder)


def with_duration(log_rows: DataFrame) -> DataFrame:
    """Add the whole seconds each step took."""
    seconds = F.unix_timestamp("load_end") - F.unix_timestamp("load_start")
    return log_rows.withColumn("duration_seconds", seconds)


def layer_durations(log_rows: DataFrame) -> DataFrame:
    """Steps and whole seconds of each layer: of its steps together, and from first start to last end."""
    timed = with_duration(log_rows).withColumn("layer", F.split_part("procedure_name", F.lit("."), F.lit(1)))
    return timed.groupBy("layer").agg(
        F.count("*").alias("steps"),
        F.sum("duration_seconds").alias("step_seconds"),
        (F.unix_timestamp(F.max("load_end")) - F.unix_timestamp(F.min("load_start"))).alias("layer_seconds"),
    )
