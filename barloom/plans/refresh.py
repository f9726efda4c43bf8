"""The layer refresh: landing -> bronze -> silver -> gold, each task checked before it publishes.

Every task follows one protocol: stage the candidate tables, check the stored rows, append the check results, stop on a
failed CRITICAL check, publish all tables of the task in one commit. What was checked is byte for byte what readers get,
and nothing is computed twice. A run-audit row is appended either way.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.daily import WORKING_COLUMNS, daily_metrics
from barloom.operators.flags import base_date_value, entity_profile, volume_status
from barloom.operators.layer_checks import (
    bronze_checks,
    bronze_failures,
    daily_profile,
    gold_checks,
    gold_failures,
    silver_checks,
    silver_failures,
)
from barloom.operators.lineage import dimension, source_lineage, with_lineage
from barloom.operators.periods import monthly_metrics, yearly_metrics
from barloom.operators.quality import failed_critical
from barloom.operators.summary import summary_metrics
from barloom.operators.validate import reject_reasons, split_rows, type_bars
from barloom.plans.descriptions import GOLD_COMMENTS
from barloom.settings import Settings
from barloom.sources.catalog import (
    FAILED,
    SUCCEEDED,
    append_audit,
    append_failures,
    append_results,
    apply_comments,
    set_up,
)
from barloom.sources.landing import read_daily, read_headers, read_summaries, require_known_folders
from barloom.sources.store import SnapshotStore
from barloom.spec import PRICE_COLUMNS

# Published columns in order.
SILVER_COLUMNS = (
    "ticker", "trade_date", *PRICE_COLUMNS, "volume", "volume_status", "source_ingested_at", "source_file",
    "source_run_id", "pipeline_run_id", "processed_at",
)
QUARANTINE_COLUMNS = (
    "source_date", *PRICE_COLUMNS, "volume", "ingested_at_utc", "ticker", "source_file", "bronze_loaded_at",
    "bronze_pipeline_run_id", "_rescued_data", "reject_reason", "pipeline_run_id", "quarantined_at",
)

# The key of each measure table.
GOLD_KEYS = {
    "dim_ticker": ["ticker"],
    "fact_daily_metrics": ["ticker", "trade_date"],
    "fact_monthly_metrics": ["ticker", "month_start"],
    "fact_yearly_metrics": ["ticker", "year"],
    "ticker_summary": ["ticker"],
}


class ChecksFailed(RuntimeError):
    """A CRITICAL check failed; the task has published nothing."""


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc)


@dataclass
class TaskRun:
    """One task of one run: its ids, its clock, and the row counts its audit row reports."""

    spark: SparkSession
    settings: Settings
    task: str
    run_id: str
    job_run_id: str | None = None
    started_at: datetime.datetime = field(default_factory=_now)
    rows_in: int | None = None
    rows_out: int | None = None
    rows_rejected: int | None = None
    results: list = field(default_factory=list)

    def audit(self, status: str, error: str | None = None) -> None:
        append_audit(
            self.spark, self.settings, self.run_id, self.task, status, self.started_at, _now(), self.job_run_id,
            self.rows_in, self.rows_out, self.rows_rejected, error,
        )

    def gate(self, checks: DataFrame, failures: dict[str, DataFrame]) -> None:
        """Evaluate the checks, record every result and every failing item, and raise if a CRITICAL check failed. Of
        ``failures`` (by check name) only those of checks that counted something are read."""
        self.results = checks.collect()
        append_results(self.spark, self.settings, self.results, self.run_id, _now())
        counted = [r["check_name"] for r in self.results if r["failing_count"] != 0 and r["check_name"] in failures]
        if counted:
            found = reduce(DataFrame.unionByName, [failures[name] for name in counted])
            append_failures(self.spark, self.settings, found, self.run_id)
        failed = failed_critical(self.results)
        if failed:
            named = "; ".join(f"{r['check_name']} ({r['details']})" for r in failed)
            raise ChecksFailed(f"{self.task}: nothing published, CRITICAL checks failed: {named}")


@contextmanager
def task_run(
    spark: SparkSession, settings: Settings, task: str, run_id: str, job_run_id: str | None
) -> Iterator[TaskRun]:
    run = TaskRun(spark, settings, task, run_id, job_run_id)
    try:
        yield run
    except Exception as error:
        run.audit(FAILED, f"{type(error).__name__}: {error}")
        raise
    run.audit(SUCCEEDED)


def refresh_bronze(spark: SparkSession, settings: Settings, run_id: str, job_run_id: str | None = None) -> TaskRun:
    """Landed files to raw tables, every source value kept as text."""
    store = SnapshotStore(spark, settings)
    with task_run(spark, settings, "bronze_ingest", run_id, job_run_id) as run:
        daily = store.stage(
            "bronze", "daily_prices_raw", read_daily(spark, settings, run_id, run.started_at), run_id
        )
        summaries = store.stage(
            "bronze", "source_run_summary", read_summaries(spark, settings, run_id, run.started_at), run_id
        )
        raw = store.staged(daily)
        run.rows_in = raw.count()
        heads = store.stage("ops", "landed_headers", read_headers(spark, settings), run_id)
        # Every landed file is in one of the two: a CSV file has a header row, if only an empty one.
        files = store.staged(heads).select("ticker", F.col("path").alias("source_file"))
        require_known_folders(files.unionByName(store.staged(summaries).select("ticker", "source_file")))
        landed = (settings.entities(spark), raw, store.staged(summaries), store.staged(heads))
        run.gate(bronze_checks(*landed), bronze_failures(*landed))
        store.publish(run_id, run.task, [daily, summaries])
        run.rows_out, run.rows_rejected = run.rows_in, 0
    return run


def build_silver(
    flagged: DataFrame, source_runs: DataFrame, settings: Settings, run_id: str, processed_at: datetime.datetime
) -> tuple[DataFrame, DataFrame]:
    """(valid typed rows with their volume status and source run, quarantined rows as landed), from typed rows with
    their reject reasons.

    ``source_runs`` is (ticker, source_run_id). It has one row per entity and so grows with the panel; it carries no
    broadcast hint, the planner decides by its measured size.
    """
    valid, rejected = split_rows(flagged)
    typed = valid.select(
        "ticker",
        *[F.col(f"typed.{c}").alias(c) for c in ("trade_date", *PRICE_COLUMNS, "volume", "source_ingested_at")],
        "source_file",
    )
    stamp = F.lit(processed_at).cast("timestamp")
    silver = (
        volume_status(typed, settings.panel)
        .join(source_runs, "ticker", "left")
        .withColumns({"pipeline_run_id": F.lit(run_id), "processed_at": stamp})
        .select(*SILVER_COLUMNS)
    )
    quarantine = (
        rejected.withColumnRenamed("pipeline_run_id", "bronze_pipeline_run_id")
        .withColumns({"pipeline_run_id": F.lit(run_id), "quarantined_at": stamp})
        .select(*QUARANTINE_COLUMNS)
    )
    return silver, quarantine


def entity_runs(summaries: DataFrame) -> DataFrame:
    """(ticker, source_run_id), one row per entity however many summaries it has, so that the join cannot fan out."""
    return summaries.groupBy("ticker").agg(F.max("source_run_id").alias("source_run_id"))


def refresh_silver(spark: SparkSession, settings: Settings, run_id: str, job_run_id: str | None = None) -> TaskRun:
    """Raw bars to typed, validated, flagged bars and the quarantine."""
    store = SnapshotStore(spark, settings)
    with task_run(spark, settings, "silver_transform", run_id, job_run_id) as run:
        raw = store.read("bronze", "daily_prices_raw")
        run.rows_in = raw.count()
        source_runs = entity_runs(store.read("bronze", "source_run_summary"))
        # Typed and judged once; both tables are taken from the stored rows.
        flagged = store.staged(store.stage("ops", "flagged_rows", reject_reasons(type_bars(raw)), run_id))
        silver, quarantine = build_silver(flagged, source_runs, settings, run_id, run.started_at)
        bars = store.stage("silver", "daily_prices", silver, run_id)
        rejects = store.stage("silver", "daily_prices_quarantine", quarantine, run_id)
        universe = settings.entities(spark)
        run.rows_rejected = store.staged(rejects).count()
        staged = store.staged(bars)
        profile = store.staged(store.stage("ops", "entity_profile", entity_profile(staged, settings.panel), run_id))
        layer = (staged, store.staged(rejects), profile, universe)
        run.gate(
            silver_checks(*layer, universe.count(), F.lit(run.rows_in), settings.panel),
            silver_failures(*layer, settings.panel),
        )
        store.publish(run_id, run.task, [bars, rejects])
        run.rows_out = run.rows_in - run.rows_rejected
    return run


def refresh_gold(spark: SparkSession, settings: Settings, run_id: str, job_run_id: str | None = None) -> TaskRun:
    """Typed bars to the dimension and the four measure tables. The coarser tables are built from the stored daily one,
    so the windows run once."""
    store, spec = SnapshotStore(spark, settings), settings.panel
    with task_run(spark, settings, "gold_build", run_id, job_run_id) as run:
        silver = store.read("silver", "daily_prices")
        universe = settings.entities(spark)
        run.rows_in = silver.count()
        base = base_date_value(silver, universe.count(), spec)
        if base is None:
            raise RuntimeError("no base date: on no date are enough entities normal")
        source = source_lineage(silver).first()

        def finished(frame: DataFrame) -> DataFrame:
            return with_lineage(
                frame, source["source_run_id"], source["source_ingested_at"], run_id, run.started_at
            )

        staged = {
            "fact_daily_metrics": store.stage(
                "gold", "fact_daily_metrics", finished(daily_metrics(silver, base, spec)), run_id,
                WORKING_COLUMNS,
            )
        }
        daily = store.staged(staged["fact_daily_metrics"])
        for name, frame in (
            ("fact_monthly_metrics", monthly_metrics(daily, base, spec)),
            ("fact_yearly_metrics", yearly_metrics(daily, base, spec)),
            ("ticker_summary", summary_metrics(daily, base, spec)),
            ("dim_ticker", dimension(universe)),
        ):
            staged[name] = store.stage("gold", name, finished(frame), run_id)
        tables = {name: store.staged(table) for name, table in staged.items()}
        measured = daily_profile(daily, F.lit(base), spec)
        profile = store.staged(store.stage("ops", "daily_profile", measured, run_id))
        run.gate(
            gold_checks(tables, silver, universe, F.lit(base), GOLD_KEYS, profile, spec),
            gold_failures(tables, silver, universe, GOLD_KEYS, profile, spec),
        )
        run.rows_out = profile.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
        run.rows_rejected = 0
        store.publish(run_id, run.task, list(staged.values()))
    return run


def describe_gold(spark: SparkSession, settings: Settings) -> int:
    """Comments on the published measure tables; a step of its own, so that a failure here leaves the audit of the
    build as it is."""
    return apply_comments(spark, settings, "gold", GOLD_COMMENTS)


def refresh(
    spark: SparkSession, settings: Settings, run_id: str | None = None, job_run_id: str | None = None
) -> dict[str, TaskRun]:
    """All layers under one run id. A failing task raises, and the tasks after it do not run."""
    run_id = run_id or str(uuid.uuid4())
    set_up(spark, settings)
    steps = {"bronze": refresh_bronze, "silver": refresh_silver, "gold": refresh_gold}
    runs = {layer: step(spark, settings, run_id, job_run_id) for layer, step in steps.items()}
    describe_gold(spark, settings)
    return runs
