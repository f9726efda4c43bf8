"""Session settings the plans rely on, and the shared folder for files that must outlive an executor."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# The plans need UTC dates and adaptive execution; sizes are left to the cluster's own configuration.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(
    cpus: int | str = 8, app: str = "barloom", memory: str = "8g", folder: str | None = None
) -> SparkSession:
    """A single-machine session, for tests and the benchmark. ``folder`` holds its warehouse and its intermediates."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {
        **SESSION_SETTINGS,
        "spark.sql.shuffle.partitions": str(cpus),
        # Folders are listed by tasks; on one machine a task per folder costs more than the listing.
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
        # Plans are read by tests: a scan's text is cut at 100 characters, within a long path.
        "spark.sql.maxMetadataStringLength": "1000",
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **({"spark.sql.warehouse.dir": f"{folder}/warehouse", "spark.checkpoint.dir": f"{folder}/shared"} if folder else {}),
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``, else below the session's warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir", None)
    if not root:
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors can reach")
    return f"{root.rstrip('/')}/barloom-{uuid.uuid4().hex}"


def stored(frame: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back: one pass over its inputs, however often it is used, and a
    lost executor reads files instead of computing it again."""
    spark = frame.sparkSession
    path = shared_folder(spark)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def local_rows(spark: SparkSession, rows: Iterable[tuple], ddl: str) -> DataFrame:
    """A few driver rows as a frame. Sent as an Arrow table they become a local relation, whose exact size the planner
    knows when it chooses a join."""
    schema = T.DataType.fromDDL(ddl)
    records = [dict(zip(schema.names, row, strict=True)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(schema)), schema=schema)
