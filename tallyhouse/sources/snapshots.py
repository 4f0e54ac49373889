"""Tables published as whole versions.

Data files lie in `part=<p>/batch=<b>` below the table folder; every write adds
files under a batch name of its own and touches no older file. A version is the
set of (part, batch) pairs that the log in `_versions` has as live; it is logged
after its data. Readers take the newest version, so they see all of a write or
nothing of it, and a failed write leaves the old state. Of two writers that start
from one version, the second fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .versions import VersionLog, path_exists, version_name

TAGS = [T.StructField("part", T.StringType()), T.StructField("batch", T.StringType())]

#: Codec of the data files.
COMPRESSION = "zstd"

Check = Callable[[dict[str, int]], None] | None


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


class SnapshotTable:
    """`part` is the column expression a row is filed under, none for one part.

    A part name may have a second half after a dot, `2013.07`; `2013` then names
    all of them. `balance` redistributes rows before a write so that each part gets
    few, evenly sized files: Spark splits large parts and merges small ones. Files
    are sorted by `order`, so that readers skip row groups by its ranges.
    `on_publish` is called after each new version.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        schema: T.StructType,
        part: Column | None = None,
        balance: bool = False,
        order: list[str] | None = None,
    ):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self.part, self.balance, self.order = part, balance, order or []
        self.log = VersionLog(spark, self.folder)
        self.on_publish: Callable[[], None] | None = None

    # -- reading ----------------------------------------------------------

    def read(self, parts: list[str] | None = None) -> DataFrame:
        """The newest version, or only some parts of it (other files are not listed)."""
        paths = [f"{self.folder}/part={p}/batch={b}" for p, b in self.log.pairs(parts=parts)]
        if not paths:
            return empty_table(self.spark, self.schema)
        reader = self.spark.read.schema(T.StructType(self.schema.fields + TAGS))
        return reader.option("basePath", self.folder).parquet(*paths).select(*self.schema.names)

    def parts(self) -> dict[str, int]:
        """The parts of the newest version, with the number of batches each lies in."""
        return {r.part: r["count"] for r in self.log.live().groupBy("part").count().collect()}

    def version(self) -> int:
        return self.log.newest()

    # -- writing ----------------------------------------------------------

    def replace(self, df: DataFrame, check: Check = None) -> dict[str, int]:
        """Full refresh: the new version holds exactly `df`.

        `check` gets the rows written per part and may raise to keep them unpublished.
        """
        return self._publish(df, check=check, fresh=True)

    def append(self, df: DataFrame) -> dict[str, int]:
        """Add rows; without any, no version is published."""
        return self._publish(df)

    def rewrite(self, df: DataFrame, parts: list[str]) -> dict[str, int]:
        """Swap out whole `parts` and file the rows of `df` wherever they belong."""
        return self._publish(df, parts)

    def _publish(
        self, df: DataFrame, out: list[str] | None = None, check: Check = None, fresh: bool = False
    ) -> dict[str, int]:
        begun = self.version()
        batch = f"{version_name(begun + 1)}-{uuid.uuid4().hex}"
        rows = df.select([F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        rows = rows.withColumn("part", F.lit("all") if self.part is None else self.part)
        if self.balance:
            rows = rows.hint("rebalance", "part")
        if self.order:
            rows = rows.sortWithinPartitions("part", *self.order)
        rows = rows.withColumn("batch", F.lit(batch))
        rows.write.mode("append").option("compression", COMPRESSION).partitionBy("part", "batch").parquet(self.folder)

        written = self._written(batch)
        if check is not None:
            check(written)
        dropped = self.log.live(begun).where(F.col("part").isin(out)) if out else None
        if not written and begun:
            left = self.log.live(begun) if fresh else dropped
            if left is None or left.isEmpty():
                return written
        self.log.publish(begun + 1, [(part, batch) for part in written], dropped, fresh)
        if self.on_publish is not None:
            self.on_publish()
        return written

    # -- upkeep -----------------------------------------------------------

    def compact(self, most_batches: int = 16) -> list[str]:
        """Rewrite the parts that lie in more than `most_batches` batches; their names."""
        parts = sorted(p for p, batches in self.parts().items() if batches > most_batches)
        if parts:
            self.rewrite(self.read(parts), parts)
        return parts

    def vacuum(self, keep_versions: int = 1) -> int:
        """Delete batches that none of the newest `keep_versions` versions lists; their number.

        Files of a version stay until no kept version has them, however old they are.
        Older entries of the log go too, but for those since the last whole one.
        Not to be run beside a write, whose batch is not listed yet.
        """
        if keep_versions < 1:
            raise ValueError("the newest version has to stay")
        if not path_exists(self.spark, f"{self.folder}/_versions"):
            return 0
        listed = self.log.vacuum(keep_versions)
        jvm = self.spark._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/part=*/batch=*")
        files = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration())
        gone = 0
        for status in files.globStatus(pattern) or []:
            path = status.getPath()
            part = path.getParent().getName().removeprefix("part=")
            if (part, path.getName().removeprefix("batch=")) not in listed:
                gone += bool(files.delete(path, True))
        return gone

    def _written(self, batch: str) -> dict[str, int]:
        """Rows per part of a batch, from the parquet footers."""
        written = f"{self.folder}/part=*/batch={batch}"
        if not path_exists(self.spark, written):
            return {}
        reader = self.spark.read.schema(T.StructType(self.schema.fields + TAGS))
        files = reader.option("basePath", self.folder).parquet(written)
        return {r["part"]: r["count"] for r in files.groupBy("part").count().collect()}
