"""The series panel landed as files and taken through the whole refresh, for the queries over published tables."""

from __future__ import annotations

import dataclasses
import os
import re
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.inject import replace_row_with_previous
from barloom.plans.refresh import ChecksFailed, refresh
from barloom.queries.layers import series_bars, series_universe
from barloom.session import shared_folder, stored
from barloom.settings import LAYERS, Settings
from barloom.sources.store import SnapshotStore

GOOD_RUN, FAULTY_RUN, RECOVERY_RUN = "run-1", "run-2", "run-3"
SOURCE_RUN = "source-1"
FAULT_ENTITY, FAULT_ROW = "RF", 100
INGESTED_AT = "2026-10-09 05:43:40.875883+00:00"

# Spark's folder for rows without a value, and the characters that it writes as their codes.
NO_FOLDER = "__HIVE_DEFAULT_PARTITION__"
UNFIT = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")


def land(bars: DataFrame, folder: str) -> None:
    """Write bars the way a source lands them: per entity a folder with one file of CSV text and a JSON run summary. The
    rows of an entity, at most one per day, meet in one task, so there are as many files as entities and not that times
    the tasks: each file costs the store and every later listing more than its rows do. For the same reason the tasks
    are fixed in number; by their bytes, all the run summaries would be written by one."""
    n_tasks = int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    prices = ["open", "high", "low", "close", "adjclose", "volume"]
    rows = bars.select(
        F.col("ticker").alias("folder"),
        F.date_format("trade_date", "yyyy-MM-dd").alias("Date"),
        *[F.col(c).cast("string").alias(c) for c in prices],
        F.lit(INGESTED_AT).alias("ingested_at_utc"),
    )
    write_folders(rows.repartition(n_tasks, "folder"), f"{folder}/daily", "csv")

    documents = summary_documents(bars, F.lit(0), F.concat("ticker", F.lit(".X")), F.lit(SOURCE_RUN))
    # By a hash of the folder: dealt by the folder itself, they would stay as the grouping left them, in few tasks.
    documents = documents.withColumnRenamed("entity", "folder").repartition(n_tasks, F.xxhash64("folder"))
    write_folders(documents, f"{folder}/summaries", "json")


def write_folders(rows: DataFrame, path: str, kind: str) -> None:
    """Write rows as ``csv``, with a header line, or ``json`` to a new folder ``path``, in a folder below it per value of
    ``folder``, named as Spark names them; each task writes one file per folder that it has rows of.

    Where the store is a disk that all executors share, the tasks make the files themselves: Spark's writer starts three
    processes there for every folder and its file, to set their modes, and adds a file of checksums."""
    spark, columns = rows.sparkSession, [c for c in rows.columns if c != "folder"]
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.getUri().getScheme() != "file":
        rows.write.partitionBy("folder").options(**({"header": True} if kind == "csv" else {})).format(kind).save(path)
        return
    root = place.toUri().getPath()
    os.makedirs(root)
    line = (F.to_csv if kind == "csv" else F.to_json)(F.struct(*columns))
    named = F.coalesce(F.nullif(F.col("folder").cast("string"), F.lit("")), F.lit(NO_FOLDER))
    lines = rows.select(named.alias("folder"), line.alias("line")).sortWithinPartitions("folder")
    written = lines.mapInArrow(_folder_files(root, kind, ",".join(columns) if kind == "csv" else None), "n_lines bigint")
    written.agg(F.sum("n_lines")).collect()


def _folder_files(
    root: str, kind: str, header: str | None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Writes the lines of (folder, line), sorted by folder, as they come. A file gets its name, which a repeated task
    gives it again, when it is whole."""

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n_lines, folder, out = TaskContext.get(), 0, None, None
        name = f"part-{task.partitionId():05d}.{kind}"
        unfinished = f".{name}.{task.taskAttemptId()}"

        def finish() -> None:
            if out is not None:
                out.close()
                os.replace(f"{folder}/{unfinished}", f"{folder}/{name}")

        for batch in batches:
            lines, start = batch.column(1).to_pylist(), 0
            runs = pc.run_end_encode(batch.column(0))
            for end, value in zip(runs.run_ends.to_pylist(), runs.values.to_pylist(), strict=True):
                below = f"{root}/folder={UNFIT.sub(lambda c: f'%{ord(c[0]):02X}', value)}"
                if below != folder:
                    finish()
                    folder = below
                    os.makedirs(folder, exist_ok=True)
                    out = open(f"{folder}/{unfinished}", "w", encoding="utf-8", newline="")
                    out.write(f"{header}\n" if header else "")
                out.write("\n".join(lines[start:end]) + "\n")
                start = end
            n_lines += len(lines)
        finish()
        yield pa.RecordBatch.from_pydict({"n_lines": pa.array([n_lines], pa.int64())})

    return files


def summary_documents(bars: DataFrame, extra_rows: Column, symbol: Column, run_id: Column) -> DataFrame:
    """A run summary per entity, with its ``entity``: rows declared beyond the real ones, symbol and run id may depend on ``ticker``."""
    counted = bars.groupBy("ticker").agg(F.max("trade_date").alias("last"), F.count("*").alias("n"))
    interval = F.struct(
        F.date_format("last", "yyyy-MM-dd").alias("date_max"),
        F.lit(0).cast("bigint").alias("duplicate_dates"),
        (F.col("n") + extra_rows).alias("rows"),
    )
    return counted.select(
        F.struct(*[interval.alias(i) for i in ("1d", "1mo", "1wk")]).alias("intervals"),
        run_id.alias("run_id"),
        F.col("ticker").alias("stock"),
        symbol.alias("ticker"),
        F.col("ticker").alias("entity"),
    )


@dataclasses.dataclass(frozen=True)
class Published:
    """A workspace whose tables have been published by a refresh."""

    settings: Settings
    bars: DataFrame

    @property
    def spark(self) -> SparkSession:
        return self.bars.sparkSession

    @property
    def store(self) -> SnapshotStore:
        return SnapshotStore(self.spark, self.settings)

    def table(self, layer: str, name: str) -> DataFrame:
        return self.spark.table(self.settings.table(layer, name))


@lru_cache(maxsize=4)
def _published(spark: SparkSession, application: str, sf_dir: str) -> Published:
    root, tag = shared_folder(spark), uuid.uuid4().hex[:8]
    bars = stored(series_bars(spark, sf_dir))
    land(bars, f"{root}/landing")
    series_universe(bars).write.parquet(f"{root}/universe")
    settings = Settings(
        warehouse=f"{root}/warehouse",
        landing_path=f"{root}/landing",
        universe=f"{root}/universe",
        schemas={layer: f"{layer}_{tag}" for layer in LAYERS},
        daily_glob="daily/*/*.csv",
        summary_glob="summaries/*/*.json",
    )
    refresh(spark, settings, GOOD_RUN, GOOD_RUN)
    return Published(settings, bars)


@lru_cache(maxsize=4)
def _recovered(spark: SparkSession, application: str, sf_dir: str) -> Published:
    good = _published(spark, application, sf_dir)
    root = f"{shared_folder(spark)}/test_fixtures"
    land(replace_row_with_previous(good.bars, "ticker", "trade_date", FAULT_ENTITY, FAULT_ROW), root)
    try:
        refresh(spark, dataclasses.replace(good.settings, landing_path=root), FAULTY_RUN, FAULTY_RUN)
    except ChecksFailed:
        pass
    else:
        raise AssertionError("the planted duplicate was not caught")
    refresh(spark, good.settings, RECOVERY_RUN, RECOVERY_RUN)
    return good


def published(spark: SparkSession, sf_dir: str) -> Published:
    """Land and refresh once per session and data set; the queries read the published tables."""
    return _published(spark, spark.sparkContext.applicationId, sf_dir)


def recovered(spark: SparkSession, sf_dir: str) -> Published:
    """The same workspace after a run over faulty files, which must fail, and a run that recovers."""
    return _recovered(spark, spark.sparkContext.applicationId, sf_dir)
