"""Catalog administration: schemas and history tables, comments, metadata scans, reset."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.catalog import Table

from barloom.operators.quality import FAILURE_COLUMNS, FAILURE_SCHEMA, RESULT_SCHEMA
from barloom.session import local_rows
from barloom.settings import Settings
from barloom.sources.store import MANIFEST_SCHEMA

# Run-audit columns in order, and its statuses.
AUDIT_SCHEMA = (
    "pipeline_run_id STRING, task_name STRING, job_run_id STRING, started_at TIMESTAMP, ended_at TIMESTAMP, "
    "status STRING, rows_in BIGINT, rows_out BIGINT, rows_rejected BIGINT, error_message STRING"
)
SUCCEEDED, FAILED = "SUCCEEDED", "FAILED"

# All tables, in the order a reset drops them.
ALL_TABLES = (
    ("gold", "ticker_summary"),
    ("gold", "fact_yearly_metrics"),
    ("gold", "fact_monthly_metrics"),
    ("gold", "fact_daily_metrics"),
    ("gold", "dim_ticker"),
    ("silver", "daily_prices_quarantine"),
    ("silver", "daily_prices"),
    ("bronze", "source_run_summary"),
    ("bronze", "daily_prices_raw"),
    ("ops", "check_failures"),
    ("ops", "dq_results"),
    ("ops", "run_audit"),
)
OPS_TABLES = {
    "run_audit": AUDIT_SCHEMA,
    "dq_results": RESULT_SCHEMA,
    "check_failures": FAILURE_SCHEMA,
    "run_manifest": MANIFEST_SCHEMA,
}
RESET_WORD = "RESET"


def set_up(spark: SparkSession, settings: Settings) -> None:
    """Create the schemas and history tables that are absent, then verify that all of them exist."""
    root = settings.warehouse.rstrip("/")
    for schema in settings.schemas.values():
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {settings.catalog}.{schema} LOCATION '{root}/{schema}'")
    history = f"{root}/{settings.schemas['ops']}"
    for name, ddl in OPS_TABLES.items():
        table = settings.table("ops", name)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet LOCATION '{history}/{name}'")
    missing = [s for s in settings.schemas.values() if not spark.catalog.databaseExists(f"{settings.catalog}.{s}")]
    missing += [n for n in OPS_TABLES if not spark.catalog.tableExists(settings.table("ops", n))]
    if missing:
        raise RuntimeError(f"setup incomplete, missing: {missing}")


def append_audit(
    spark: SparkSession,
    settings: Settings,
    run_id: str,
    task: str,
    status: str,
    started_at: datetime.datetime,
    ended_at: datetime.datetime,
    job_run_id: str | None = None,
    rows_in: int | None = None,
    rows_out: int | None = None,
    rows_rejected: int | None = None,
    error: str | None = None,
) -> None:
    """Append one run-audit row, the error text whole. A blank job run id is stored as NULL."""
    known = {SUCCEEDED, FAILED}
    if status not in known:
        raise ValueError(f"status must be one of {sorted(known)}, got {status!r}")
    row = (run_id, task, job_run_id or None, started_at, ended_at, status, rows_in, rows_out, rows_rejected, error)
    local_rows(spark, [row], AUDIT_SCHEMA).coalesce(1).write.insertInto(settings.table("ops", "run_audit"))


def append_results(
    spark: SparkSession, settings: Settings, results: list, run_id: str, checked_at: datetime.datetime
) -> None:
    """Append check results (one row per check) to the history."""
    rows = [
        (run_id, r["check_name"], r["layer"], r["severity"], r["passed"], r["failing_count"], r["expected"],
         r["details"], checked_at)
        for r in results
    ]
    local_rows(spark, rows, RESULT_SCHEMA).coalesce(1).write.insertInto(settings.table("ops", "dq_results"))


def append_failures(spark: SparkSession, settings: Settings, failures: DataFrame, run_id: str) -> None:
    """Append what failed, one row per failing item, written by the tasks that find it."""
    rows = failures.select(F.lit(run_id).alias("pipeline_run_id"), *FAILURE_COLUMNS)
    rows.write.insertInto(settings.table("ops", "check_failures"))


def sql_literal(text: str) -> str:
    """A Spark SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def apply_comments(
    spark: SparkSession, settings: Settings, layer: str, tables: dict[str, tuple[str, dict[str, str]]]
) -> int:
    """Put a comment on each table and on the named columns; returns the number of statements run."""
    done = 0
    for name, (about, columns) in tables.items():
        table = settings.table(layer, name)
        spark.sql(f"COMMENT ON TABLE {table} IS {sql_literal(about)}")
        for column, text in columns.items():
            spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{column}` COMMENT {sql_literal(text)}")
        done += 1 + len(columns)
    return done


def tables_of(spark: SparkSession, schema: str) -> list[Table]:
    """The tables of a schema. The catalog lists the session's temporary views with those of any schema."""
    return [t for t in spark.catalog.listTables(schema) if not t.isTemporary]


def table_metadata(spark: SparkSession, settings: Settings, layer: str) -> DataFrame:
    """(table_name, comment) of a schema, ordered by name."""
    schema = f"{settings.catalog}.{settings.schemas[layer]}"
    rows = [(t.name, t.description) for t in tables_of(spark, schema)]
    return local_rows(spark, rows, "table_name STRING, comment STRING").orderBy("table_name")


def column_metadata(spark: SparkSession, settings: Settings, layer: str) -> DataFrame:
    """(table_name, ordinal_position, column_name, data_type, comment) of every column of a schema."""
    schema = f"{settings.catalog}.{settings.schemas[layer]}"
    rows = [
        (t.name, i, c.name, c.dataType, c.description)
        for t in tables_of(spark, schema)
        for i, c in enumerate(spark.catalog.listColumns(f"{schema}.{t.name}"), start=1)
    ]
    ddl = "table_name STRING, ordinal_position INT, column_name STRING, data_type STRING, comment STRING"
    return local_rows(spark, rows, ddl)


def drop_all(spark: SparkSession, settings: Settings, confirm: str | None) -> tuple[list[str], list[str]]:
    """Drop every table of the model, measures first, and the publish manifest last. Only the exact confirm word does
    it. The history tables are emptied, so a later setup starts clean; the landed files and the snapshot directories
    stay. Returns (dropped, already absent)."""
    if (confirm or "").strip() != RESET_WORD:
        raise PermissionError(f"nothing dropped: confirm must be {RESET_WORD}")
    dropped, absent = [], []
    for layer, name in (*ALL_TABLES, ("ops", "run_manifest")):
        table = settings.table(layer, name)
        if not spark.catalog.tableExists(table):
            absent.append(table)
            continue
        if layer == "ops":
            local_rows(spark, [], OPS_TABLES[name]).write.insertInto(table, overwrite=True)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        dropped.append(table)
    return dropped, absent
