"""The log of a table: which batches of which parts each version added and dropped.

Version n is the folder `_versions/v<n>` with one small parquet file, rows of
(version, part, batch, added). A row without a part says that nothing older counts.
A version that has such a row holds the whole list of live batches, and an empty
file `v<n>.whole` beside it tells readers to start there: full refreshes are whole,
and so is every tenth of other versions, so that a reader never has more than
ten files to read, however many versions there were.

A version is written under a name of its own and renamed. Where a folder of its
number is there already the rename fails, so that of two writers one is refused.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Versions between two that hold the whole list.
WHOLE_EVERY = 10

_WHOLE = ".whole"
_ROWS = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("part", T.StringType()),
        T.StructField("batch", T.StringType()),
        T.StructField("added", T.BooleanType()),
    ]
)

Pairs = list[tuple[str, str]]


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or one that a pattern names, is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path))


def version_name(version: int) -> str:
    """Names that sort as their numbers do."""
    return f"v{version:010d}"


class VersionLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, f"{folder}/_versions"

    # -- reading ----------------------------------------------------------

    def _files(self) -> tuple[list[int], list[int]]:
        """Numbers of the versions, and of those that hold the whole list, ascending."""
        found = self._system().globStatus(self._path("v*")) or []
        names = [status.getPath().getName()[1:] for status in found]
        versions = sorted(int(n) for n in names if not n.endswith(_WHOLE))
        return versions, sorted(int(n.removesuffix(_WHOLE)) for n in names if n.endswith(_WHOLE))

    def newest(self) -> int:
        """Number of the newest version, from the names alone; 0 without any."""
        versions, _ = self._files()
        return versions[-1] if versions else 0

    def live(self, at: int | None = None, parts: list[str] | None = None) -> DataFrame:
        """(part, batch) of a version, the newest if none is given; perhaps of some parts.

        Of `parts`, a name without a dot stands for all that begin with it and a dot.
        """
        # a few small files, so one task: nothing is shuffled
        rows = self._rows(at).coalesce(1)
        begin = F.max(F.when(F.col("part").isNull(), F.col("version"))).over(Window.partitionBy())
        rows = rows.withColumn("begin", begin).where("part IS NOT NULL AND version >= coalesce(begin, 0)")
        if parts is not None:
            rows = rows.where(F.col("part").isin(parts) | F.split_part("part", F.lit("."), F.lit(1)).isin(parts))
        return rows.groupBy("part", "batch").agg(F.bool_and("added").alias("kept")).where("kept").drop("kept")

    def pairs(self, at: int | None = None, parts: list[str] | None = None) -> Pairs:
        """`live` as a list: the folders a reader has to name."""
        return [(r.part, r.batch) for r in self.live(at, parts).collect()]

    def _rows(self, at: int | None = None) -> DataFrame:
        versions, whole = self._files()
        versions = [v for v in versions if at is None or v <= at]
        start = max((v for v in whole if versions and v <= versions[-1]), default=0)
        return self._read([v for v in versions if v >= start])

    def _read(self, versions: list[int]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], _ROWS)
        return self.spark.read.schema(_ROWS).parquet(*[f"{self.folder}/{version_name(v)}" for v in versions])

    # -- writing ----------------------------------------------------------

    def publish(self, version: int, added: Pairs, dropped: DataFrame | None = None, fresh: bool = False) -> None:
        """Make `version`, the one after the newest, visible.

        `dropped` are the (part, batch) that no longer count; with `fresh` none of
        the older ones does. Raises RuntimeError if the version is there already.
        """
        rows = self._listed([{"version": version, "part": p, "batch": b, "added": True} for p, b in added])
        whole = fresh or version % WHOLE_EVERY == 0
        if whole:
            rows = rows.unionByName(self._listed([{"version": version, "added": False}]))
        if whole and not fresh:
            kept = self.live()
            if dropped is not None:
                kept = kept.join(dropped, ["part", "batch"], "left_anti")
            rows = rows.unionByName(kept.select(F.lit(version).alias("version"), "*", F.lit(True).alias("added")))
        elif dropped is not None and not fresh:
            rows = rows.unionByName(dropped.select(F.lit(version).alias("version"), "*", F.lit(False).alias("added")))
        draft = f"_draft-{uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(f"{self.folder}/{draft}")
        self._rename(draft, version)
        if whole:
            self._system().createNewFile(self._path(version_name(version) + _WHOLE))

    def _listed(self, rows: list[dict]) -> DataFrame:
        listed = F.from_json(F.lit(json.dumps(rows)), T.ArrayType(_ROWS))
        return self.spark.range(1, numPartitions=1).select(F.inline(listed))

    def _rename(self, draft: str, version: int) -> None:
        jvm = self.spark._jvm
        system = self._system()
        source, target = (
            self._path(name).makeQualified(system.getUri(), system.getWorkingDirectory())
            for name in (draft, version_name(version))
        )
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            target.toUri(), self.spark._jsc.hadoopConfiguration()
        )
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(source, target, options)
        except Exception:
            if not system.exists(target):
                raise
            system.delete(source, True)
            raise RuntimeError(f"{self.folder}: version {version} came up while it was written") from None

    # -- upkeep -----------------------------------------------------------

    def vacuum(self, keep_versions: int) -> set[tuple[str, str]]:
        """Drop versions that the newest `keep_versions` can do without; all batches those list."""
        versions, whole = self._files()
        kept = versions[-keep_versions:]
        listed = set(self.pairs(kept[0])) if kept else set()
        later = self._read(kept[1:]).where("added").select("part", "batch").distinct()
        listed |= {(r.part, r.batch) for r in later.collect()}
        start = max((v for v in whole if kept and v <= kept[0]), default=0)
        for version in versions:
            if version < start:
                self._system().delete(self._path(version_name(version) + _WHOLE), False)
                self._system().delete(self._path(version_name(version)), True)
        return listed

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _system(self):
        return self._path("v").getFileSystem(self.spark._jsc.hadoopConfiguration())
