"""Names in the catalog that follow the versions of published tables.

A table has two entries: `published.<layer>_<name>`, an external table over the
table folder with one catalog partition for each (part, batch), and the view
`<layer>.<name>` over it, which is what users read. A new version adds its
partitions, which the view does not show yet as it ends at an older version; then
the view is replaced, in one step; then the partitions that it no longer shows are
dropped. So readers by name see one version or the next, and scans list live
files only.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .snapshots import SnapshotTable
from .versions import version_name

FILES = "published"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class TableName:
    """The view `<layer>.<name>`, over some `columns` and one `part` if they are given."""

    def __init__(
        self,
        spark: SparkSession,
        table: SnapshotTable,
        layer: str,
        name: str,
        columns: list[str] | None = None,
        part: str | None = None,
    ):
        self.spark, self.table, self.part = spark, table, part
        self.view, self.files = f"{layer}.{name}", f"{FILES}.{layer}_{name}"
        self.columns = columns or table.schema.names

    def create(self) -> None:
        """Make both entries anew over the newest version; the databases are there already."""
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.table.schema.fields)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.files}")
        self.spark.sql(
            f"CREATE TABLE {self.files} ({fields}, part STRING, batch STRING) USING parquet "
            f"PARTITIONED BY (part, batch) LOCATION {_quoted(self.table.folder)}"
        )
        self.follow()

    def follow(self) -> None:
        """Catch up with the newest version, from whatever state an earlier step left."""
        version = self.table.version()
        live = set(self.table.log.pairs(version))
        shown = {
            tuple(half.split("=", 1)[1] for half in row.partition.split("/"))
            for row in self.spark.sql(f"SHOW PARTITIONS {self.files}").collect()
        }
        new, gone = sorted(live - shown), sorted(shown - live)
        if new:
            self.spark.sql(f"ALTER TABLE {self.files} ADD IF NOT EXISTS {self._partitions(new, ' ')}")
        self._show(version, gone)
        if gone:
            self.spark.sql(f"ALTER TABLE {self.files} DROP IF EXISTS {self._partitions(gone, ', ')}")

    def _show(self, version: int, without: list[tuple[str, str]]) -> None:
        # batches are named after their versions; "~" sorts behind all that follows a version in a name
        wanted = [f"batch <= {_quoted(version_name(version) + '~')}"]
        if self.part is not None:
            wanted.append(f"part = {_quoted(self.part)}")
        if without:
            listed = ", ".join(_quoted(f"{part}/{batch}") for part, batch in without)
            wanted.append(f"concat(part, '/', batch) NOT IN ({listed})")
        columns = ", ".join(f"`{name}`" for name in self.columns)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.view} AS SELECT {columns} FROM {self.files} WHERE {' AND '.join(wanted)}"
        )

    @staticmethod
    def _partitions(pairs: list[tuple[str, str]], between: str) -> str:
        return between.join(f"PARTITION (part={_quoted(part)}, batch={_quoted(batch)})" for part, batch in pairs)
