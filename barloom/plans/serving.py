"""Dataset queries over the published measure tables, with their filters. No measure is computed here."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summary_dataset(summary: DataFrame, dim: DataFrame) -> DataFrame:
    """Summary rows with the entity's names. Both tables grow with the universe, so the planner sizes the join."""
    names = dim.select("ticker", "short_name", "bank_name")
    return (
        summary.join(names, "ticker")
        .select(
            "ticker", "short_name", "bank_name", "total_return", "vol_full_ann", "max_drawdown", "peak_date",
            "trough_date", "current_drawdown", "base_date", "last_trade_date", "source_run_id", "source_ingested_at",
        )
        .orderBy("ticker")
    )


def daily_dataset(daily: DataFrame) -> DataFrame:
    return daily.select(
        "ticker", "trade_date", "normalized_index", "daily_return", "vol_60d_ann", "drawdown", "rel_volume_60d",
        "volume_status",
    ).orderBy("ticker", "trade_date")


def monthly_dataset(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        "ticker", "month_start", "monthly_return", "avg_daily_volume", "n_sessions", "n_normal_sessions", "is_partial"
    ).orderBy("ticker", "month_start")


def yearly_dataset(yearly: DataFrame) -> DataFrame:
    """Yearly rows with an axis label that marks the partial ones."""
    label = F.concat(F.col("year").cast("string"), F.when(F.col("is_partial"), F.lit(" (partial)")).otherwise(""))
    return yearly.select(
        "ticker", "year", "yearly_return", "n_sessions", "is_partial", label.alias("year_label")
    ).orderBy("ticker", "year")


def ranking(summary: DataFrame, measure: str) -> DataFrame:
    """Entities by one full-period measure, largest first."""
    return summary.select("ticker", measure).orderBy(F.col(measure).desc(), "ticker")


def monthly_matrix(monthly: DataFrame, entities: Sequence[str]) -> DataFrame:
    """Months down, the chosen entities across. Naming the columns saves the job that would look for them."""
    return (
        monthly.filter(F.col("ticker").isin(*entities))
        .groupBy("month_start", "is_partial")
        .pivot("ticker", list(entities))
        .agg(F.first("monthly_return"))
        .orderBy("month_start", "is_partial")
    )


def for_entities(dataset: DataFrame, entities: Sequence[str]) -> DataFrame:
    """Entity filter; applies to every dataset. An empty choice means all."""
    return dataset.filter(F.col("ticker").isin(*entities)) if entities else dataset


# The date column a range filter acts on. The summary and the yearly dataset describe fixed periods, so no
# date filter applies to them.
RANGE_COLUMNS = ("trade_date", "month_start")


def in_range(dataset: DataFrame, first: datetime.date, last: datetime.date) -> DataFrame:
    """Date filter on the dataset's range column, both ends included; raises for a dataset of fixed periods."""
    column = next((c for c in RANGE_COLUMNS if c in dataset.columns), None)
    if column is None or "total_return" in dataset.columns:
        raise ValueError("a date filter does not apply to full-period or yearly values")
    return dataset.filter(F.col(column).between(first, last))
