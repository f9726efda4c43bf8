"""Full-period measures: total return, volatility, and the deepest drawdown with its peak and trough dates."""

from __future__ import annotations

import datetime
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.exact import exact_deviation
from barloom.operators.daily import as_date
from barloom.spec import PanelSpec

# Published columns in order.
SUMMARY_COLUMNS = (
    "total_return", "vol_full_ann", "max_drawdown", "peak_date", "trough_date", "current_drawdown", "base_date",
    "last_trade_date",
)


def summary_metrics(daily: DataFrame, base: datetime.date | Column, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """One row per entity, in one grouped pass over the daily measures (with their working column).

    The smallest (drawdown, date, peak date) struct is the deepest drawdown, its earliest date if tied, and the day the
    peak in force then was set. The volatility comes from exact sums, so it does not depend on how the rows are dealt.
    """
    base = as_date(base)
    deepest = F.struct("drawdown", F.col(spec.date).alias("day"), F.col("running_peak_date").alias("peak"))
    latest = F.struct(F.col(spec.date).alias("day"), "adjclose", "drawdown")
    return (
        daily.groupBy(spec.entity)
        .agg(
            F.min(deepest).alias("deepest"),
            F.max(latest).alias("latest"),
            F.max(F.when(F.col(spec.date) == base, F.col("adjclose"))).alias("base_adjclose"),
            (exact_deviation(F.col("daily_return")) * math.sqrt(spec.annualization)).alias("vol_full_ann"),
        )
        .select(
            spec.entity,
            (F.col("latest.adjclose") / F.col("base_adjclose") - 1).alias("total_return"),
            "vol_full_ann",
            F.col("deepest.drawdown").alias("max_drawdown"),
            F.col("deepest.peak").alias("peak_date"),
            F.col("deepest.day").alias("trough_date"),
            F.col("latest.drawdown").alias("current_drawdown"),
            base.cast("date").alias("base_date"),
            F.col("latest.day").alias("last_trade_date"),
        )
    )
