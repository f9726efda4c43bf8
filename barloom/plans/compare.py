"""Rerun check: the latest two published versions of every table, compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.checksums import SUMS_SCHEMA, bucket_checksums, two_stage_diff
from barloom.operators.diff import DOUBLE_TOLERANCE, METRICS_SCHEMA, snapshot_diff, verdict
from barloom.session import local_rows
from barloom.settings import Settings
from barloom.sources.store import SnapshotStore

#: What the folder of a version's checksums is called after that of the version.
CHECKSUMS = "-checksums"

# The compared tables and their keys; None compares row counts only.
COMPARED = {
    ("bronze", "daily_prices_raw"): ["ticker", "source_date"],
    ("bronze", "source_run_summary"): ["ticker"],
    ("silver", "daily_prices"): ["ticker", "trade_date"],
    ("silver", "daily_prices_quarantine"): None,
    ("gold", "dim_ticker"): ["ticker"],
    ("gold", "fact_daily_metrics"): ["ticker", "trade_date"],
    ("gold", "fact_monthly_metrics"): ["ticker", "month_start"],
    ("gold", "fact_yearly_metrics"): ["ticker", "year"],
    ("gold", "ticker_summary"): ["ticker"],
}


def store_checksums(spark: SparkSession, settings: Settings) -> None:
    """Write the checksums of the published versions that have none yet, each next to its files."""
    store = SnapshotStore(spark, settings)
    newest = store.latest_two_of_each()
    for table, keys in COMPARED.items():
        known = None
        for version in reversed(newest.get(table, [])) if keys else []:
            path = version["path"] + CHECKSUMS
            if not _exists(spark, path):
                bucket_checksums(store.open(version), keys, known=known).coalesce(1).write.parquet(path)
            known = _checksums(spark, path)


def _checksums(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUMS_SCHEMA).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    """A written table has its success mark."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def rerun_report(
    spark: SparkSession, settings: Settings, tolerance: float = DOUBLE_TOLERANCE, checksums: bool = False
) -> DataFrame:
    """One row per table: the two versions, the comparison metrics, and PASS, FAIL or SKIPPED (no earlier version). With
    ``checksums`` (see ``store_checksums``) only rows of buckets that differ are compared. A rerun over the same files
    passes with a tolerance of 0, too: no measure depends on the order of its rows."""
    store = SnapshotStore(spark, settings)
    published = store.latest_two_of_each()
    rows = None
    for (layer, name), keys in COMPARED.items():
        newest = published.get((layer, name), [])
        if len(newest) < 2:
            metrics = local_rows(spark, [(None,) * 6 + ("no previous version",)], METRICS_SCHEMA)
            outcome, versions = F.lit("SKIPPED"), (None, newest[0]["version"] if newest else None)
        else:
            versions = (newest[1]["version"], newest[0]["version"])
            sides = [store.open(v) for v in (newest[1], newest[0])]
            sums = [v["path"] + CHECKSUMS for v in (newest[1], newest[0])]
            if checksums and keys and all(_exists(spark, path) for path in sums):
                metrics = two_stage_diff(*sides, *[_checksums(spark, path) for path in sums], keys)
            else:
                metrics = snapshot_diff(*sides, keys)
            outcome = verdict(tolerance)
        row = metrics.select(
            F.lit(settings.table(layer, name)).alias("table"),
            F.lit(versions[0]).cast("bigint").alias("version_prev"),
            F.lit(versions[1]).cast("bigint").alias("version_latest"),
            "rows_prev",
            "rows_latest",
            "dup_keys",
            "missing_rows",
            "mismatched_non_double",
            "max_double_diff",
            outcome.alias("result"),
            F.when(F.col("note") != "", F.col("note")).alias("note"),
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows


def overall(report: DataFrame) -> str:
    """PASS only if every table passed; a skipped table is not a pass."""
    return "PASS" if report.agg(F.bool_and(F.col("result") == "PASS")).first()[0] else "FAIL"
