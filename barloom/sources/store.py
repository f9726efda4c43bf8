"""Snapshot tables: every run writes a new directory, and one manifest row publishes all tables of a task at once.

Nothing published is ever overwritten, so earlier versions stay readable, a failed run leaves the last good one in
place, and a lost executor costs a task retry against files that do not change.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.session import local_rows
from barloom.settings import Settings

MANIFEST_SCHEMA = (
    "publish_id STRING, pipeline_run_id STRING, task_name STRING, "
    "tables ARRAY<STRUCT<layer: STRING, name: STRING, path: STRING, ddl: STRING>>, published_at TIMESTAMP"
)


@dataclass(frozen=True)
class Staged:
    """A table written but not yet published."""

    layer: str
    name: str
    path: str
    schema: T.StructType
    hidden: tuple[str, ...] = ()

    @property
    def published_schema(self) -> T.StructType:
        return T.StructType([f for f in self.schema if f.name not in self.hidden])


class SnapshotStore:
    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark = spark
        self.settings = settings
        self.manifest_table = settings.table("ops", "run_manifest")

    # ------------------------------------------------------------ write

    def stage(self, layer: str, name: str, frame: DataFrame, run_id: str, hidden: tuple[str, ...] = ()) -> Staged:
        """Write a candidate to a fresh directory. ``hidden`` columns are stored for later steps but not published."""
        attempt = f"{run_id}-{uuid.uuid4().hex[:8]}"
        path = f"{self.settings.warehouse.rstrip('/')}/{self.settings.schemas[layer]}/{name}/{attempt}"
        frame.write.mode("errorifexists").parquet(path)
        return Staged(layer, name, path, frame.schema, hidden)

    def staged(self, table: Staged) -> DataFrame:
        return self.spark.read.schema(table.schema).parquet(table.path)

    def publish(self, run_id: str, task: str, tables: list[Staged]) -> None:
        """Append one manifest row for all the tables, then point their catalog entries at the new directories. The row
        is the commit: readers through this store switch to the new tables together or not at all."""
        entries = [
            {"layer": t.layer, "name": t.name, "path": t.path, "ddl": t.published_schema.simpleString()} for t in tables
        ]
        row = [(uuid.uuid4().hex, run_id, task, entries)]
        schema = MANIFEST_SCHEMA.rsplit(", published_at", 1)[0]
        (
            local_rows(self.spark, row, schema)
            .withColumn("published_at", F.current_timestamp())
            .coalesce(1)
            .write.insertInto(self.manifest_table)
        )
        for t in tables:
            self._point(self.settings.table(t.layer, t.name), t.path, t.published_schema)

    def _point(self, table: str, path: str, schema: T.StructType) -> None:
        bare = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        if self.spark.catalog.tableExists(table):
            current = T.StructType([T.StructField(f.name, f.dataType) for f in self.spark.table(table).schema])
            if current == bare:
                self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
                self.spark.catalog.refreshTable(table)
                return
            self.spark.sql(f"DROP TABLE {table}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in bare)
        self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{path}'")

    def sync(self) -> None:
        """Point every catalog entry at the latest published directory, as after a new session or a driver lost between
        the commit and the pointer change."""
        latest = self.versions().groupBy("layer", "name").agg(F.max_by(F.struct("path", "ddl"), "version").alias("t"))
        for row in latest.collect():
            schema = T.DataType.fromDDL(row["t"]["ddl"])
            self._point(self.settings.table(row["layer"], row["name"]), row["t"]["path"], schema)

    # ------------------------------------------------------------ read

    def versions(self) -> DataFrame:
        """(layer, name, version, pipeline_run_id, task_name, path, ddl, published_at), versions counted from 0."""
        in_order = Window.partitionBy("layer", "name").orderBy("published_at", "publish_id")
        return self.spark.table(self.manifest_table).select("*", F.inline("tables")).select(
            "layer",
            "name",
            (F.row_number().over(in_order) - 1).alias("version"),
            "pipeline_run_id",
            "task_name",
            "path",
            "ddl",
            "published_at",
        )

    def history(self, layer: str, name: str) -> DataFrame:
        return self.versions().filter((F.col("layer") == layer) & (F.col("name") == name)).drop("layer", "name")

    def latest_two(self, layer: str, name: str) -> list:
        """The latest published versions, newest first; fewer than two if there are not that many."""
        return self.history(layer, name).orderBy(F.col("version").desc()).limit(2).collect()

    def latest_two_of_each(self) -> dict[tuple[str, str], list]:
        """``latest_two`` of every table that has been published, by (layer, name), from one reading of the manifest."""
        newest_first = Window.partitionBy("layer", "name").orderBy(F.col("version").desc())
        newest = self.versions().withColumn("place", F.row_number().over(newest_first)).where("place <= 2")
        found: dict[tuple[str, str], list] = {}
        for row in sorted(newest.collect(), key=lambda r: r["place"]):
            found.setdefault((row["layer"], row["name"]), []).append(row)
        return found

    def open(self, version: Row) -> DataFrame:
        """The published table of a row of ``versions``; the manifest is not read again."""
        return self.spark.read.schema(T.DataType.fromDDL(version["ddl"])).parquet(version["path"])

    def read(self, layer: str, name: str, version: int | None = None, run_id: str | None = None) -> DataFrame:
        """A published table: the latest, or that of a version number or a run."""
        wanted = self.history(layer, name)
        if version is not None:
            wanted = wanted.filter(F.col("version") == version)
        if run_id is not None:
            wanted = wanted.filter(F.col("pipeline_run_id") == run_id)
        found = wanted.orderBy(F.col("version").desc()).first()
        if found is None:
            raise LookupError(f"no published version of {layer}.{name} (version={version}, run_id={run_id})")
        return self.open(found)
