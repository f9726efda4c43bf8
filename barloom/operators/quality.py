"""Data-quality checks: results computed in Spark, gated on the driver.

A check layer is built as a few one-row aggregates, each holding many counts, so the data is read a handful of times
for thirty checks. Results only become driver rows at the gate, where there is one per check; the failing
items themselves, however many, go from the tasks into the failures table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Severities, and the result columns in order.
CRITICAL, WARN, INFO = "CRITICAL", "WARN", "INFO"
SEVERITIES = (CRITICAL, WARN, INFO)
RESULT_SCHEMA = (
    "pipeline_run_id STRING, check_name STRING, layer STRING, severity STRING, passed BOOLEAN, failing_count BIGINT, "
    "expected STRING, details STRING, checked_at TIMESTAMP"
)
FAILURE_COLUMNS = ("check_name", "layer", "entity", "trade_date", "value")
FAILURE_SCHEMA = "pipeline_run_id STRING, " + ", ".join(f"{c} STRING" for c in FAILURE_COLUMNS)
CHECK_COLUMNS = ("check_name", "layer", "severity", "passed", "failing_count", "expected", "details")


@dataclass(frozen=True)
class Check:
    """One check over a one-row frame of measures. It passes when ``failing`` is 0; INFO checks always pass."""

    name: str
    severity: str
    failing: Column
    expected: str | Column = "0"
    details: str | Column = ""

    def __post_init__(self):
        if self.severity not in SEVERITIES:
            raise ValueError(f"severity {self.severity!r} is not one of {SEVERITIES}")

    def as_struct(self, layer: str) -> Column:
        def text(value: str | Column) -> Column:
            return value if isinstance(value, Column) else F.lit(value)

        failing = self.failing.cast("bigint")
        return F.struct(
            F.lit(self.name).alias("check_name"),
            F.lit(layer).alias("layer"),
            F.lit(self.severity).alias("severity"),
            (F.lit(True) if self.severity == INFO else F.coalesce(failing == 0, F.lit(False))).alias("passed"),
            failing.alias("failing_count"),
            text(self.expected).alias("expected"),
            text(self.details).alias("details"),
        )


def evaluate(measures: DataFrame, layer: str, checks: list[Check]) -> DataFrame:
    """Turn a one-row frame of measures into one row per check."""
    return measures.select(F.inline(F.array(*[c.as_struct(layer) for c in checks])))


def count_rules(frame: DataFrame, rules: dict[str, Column], **others: Column) -> DataFrame:
    """One row counting the rows that meet each rule (unknown counts as not met), plus any other aggregates."""
    return frame.agg(
        *[F.count_if(rule).alias(name) for name, rule in rules.items()],
        *[measure.alias(name) for name, measure in others.items()],
    )


def failing(
    check: str, layer: str, rows: DataFrame, entity: Column | str, trade_date: Column | str | None, value: Column
) -> DataFrame:
    """The failing items of one check in the columns of the failures table."""
    day = F.lit(None) if trade_date is None else (F.col(trade_date) if isinstance(trade_date, str) else trade_date)
    return rows.select(
        F.lit(check).alias("check_name"),
        F.lit(layer).alias("layer"),
        (F.col(entity) if isinstance(entity, str) else entity).cast("string").alias("entity"),
        day.cast("string").alias("trade_date"),
        value.cast("string").alias("value"),
    )


def failed_critical(results: list) -> list:
    """The failed CRITICAL rows; one of them is enough to stop a task before it publishes."""
    return [r for r in results if r["severity"] == CRITICAL and not r["passed"]]
