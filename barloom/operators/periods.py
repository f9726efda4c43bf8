"""Monthly and yearly returns, session counts, average volume and the partial-period flag."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.columns import last_weekday, year_end
from barloom.operators.daily import as_date
from barloom.spec import NORMAL, PanelSpec

# Published columns in order.
MONTHLY_COLUMNS = (
    "month_start", "monthly_return", "avg_daily_volume", "n_sessions", "n_normal_sessions", "is_partial",
)
YEARLY_COLUMNS = ("year", "yearly_return", "n_sessions", "is_partial")


def period_metrics(
    daily: DataFrame,
    period: Column,
    period_end: Column,
    base: datetime.date | Column,
    spec: PanelSpec = PanelSpec(),
    last_date: Column | None = None,
) -> DataFrame:
    """One row per entity and period that has bars; ``period_end`` is an expression over the column ``period``.

    A period's return is measured from the end of the previous period present, the first one from the base date. The
    base price needs no join: the base date lies in the first period, so that period's own aggregate can pick it up.
    ``is_partial`` marks each entity's first period, and the period holding the last date of the whole data set while
    weekdays of it are still to come.
    """
    base = as_date(base)
    if last_date is None:
        last_date = daily.agg(F.max(spec.date)).scalar()
    is_normal = F.col("volume_status") == NORMAL
    totals = (
        daily.withColumn("period", period)
        .groupBy(spec.entity, "period")
        .agg(
            F.max_by("adjclose", spec.date).alias("end_adjclose"),
            F.max(F.when(F.col(spec.date) == base, F.col("adjclose"))).alias("base_adjclose"),
            F.count("*").alias("n_sessions"),
            F.count_if(is_normal).alias("n_normal_sessions"),
            F.avg(F.when(is_normal, F.col("volume"))).alias("avg_daily_volume"),
            F.max(spec.date).alias("period_last_date"),
        )
    )
    periods = Window.partitionBy(spec.entity).orderBy("period")
    still_running = (F.col("period_last_date") == last_date) & (last_date < last_weekday(period_end))
    return totals.select(
        "*",
        (F.col("end_adjclose") / F.coalesce(F.lag("end_adjclose").over(periods), "base_adjclose") - 1).alias(
            "period_return"
        ),
        ((F.row_number().over(periods) == 1) | still_running).alias("is_partial"),
    )


def monthly_metrics(
    daily: DataFrame, base: datetime.date | Column, spec: PanelSpec = PanelSpec(), last_date: Column | None = None
) -> DataFrame:
    months = period_metrics(daily, F.trunc(spec.date, "month"), F.last_day("period"), base, spec, last_date)
    return months.withColumnsRenamed({"period": "month_start", "period_return": "monthly_return"}).select(
        spec.entity, *MONTHLY_COLUMNS
    )


def yearly_metrics(
    daily: DataFrame, base: datetime.date | Column, spec: PanelSpec = PanelSpec(), last_date: Column | None = None
) -> DataFrame:
    years = period_metrics(daily, F.year(spec.date), year_end(F.col("period")), base, spec, last_date)
    return years.withColumnsRenamed({"period": "year", "period_return": "yearly_return"}).select(
        spec.entity, *YEARLY_COLUMNS
    )
