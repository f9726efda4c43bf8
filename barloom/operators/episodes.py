"""Drawdown episodes: from a peak through the trough to the first day on which the price is back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.spec import PanelSpec

EPISODE_COLUMNS = (
    "peak_date", "trough_date", "recovery_date", "peak_price", "trough_price", "max_drawdown", "n_sessions_below",
    "days_to_trough", "days_to_recovery",
)


def drawdown_episodes(panel: DataFrame, spec: PanelSpec = PanelSpec(), price: str = "adjclose") -> DataFrame:
    """One row per entity and episode: a stretch of days below the highest price so far.

    A day at or above every earlier price opens a stretch that ends with the next such day, so the next price that is
    not lower is found without comparing pairs of days: the panel moves once, by entity, a running maximum marks the
    stretches, and their rows are grouped where they are. ``peak_date`` is the last day at the peak's price,
    ``recovery_date`` the first later day that reaches it again, null while the episode is open; the earliest of equal
    troughs counts. Days without a price are no part of any episode.
    """
    days = panel.where(F.col(price).isNotNull()).select(*spec.key, F.col(price).alias("price"))
    series = Window.partitionBy(spec.entity).orderBy(spec.date)
    so_far = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = days.withColumn("peak", F.max("price").over(so_far))
    at_top = F.when(F.col("price") == F.col("peak"), F.col(spec.date))
    stretches = marked.withColumn("top", F.max(at_top).over(so_far)).groupBy(spec.entity, F.col("top").alias("peak_date"))
    below = F.col("price") < F.col("peak")
    grouped = stretches.agg(
        F.max("peak").alias("peak_price"),
        F.min(F.when(below, F.struct("price", F.col(spec.date).alias("day")))).alias("trough"),
        F.count_if(below).alias("n_sessions_below"),
    )
    tops = Window.partitionBy(spec.entity).orderBy("peak_date")
    ended = grouped.withColumn("recovery_date", F.lead("peak_date").over(tops)).where("n_sessions_below > 0")
    return ended.select(
        spec.entity,
        "peak_date",
        F.col("trough.day").alias("trough_date"),
        "recovery_date",
        "peak_price",
        F.col("trough.price").alias("trough_price"),
        (F.col("trough.price") / F.col("peak_price") - 1).alias("max_drawdown"),
        "n_sessions_below",
        F.date_diff("trough.day", "peak_date").alias("days_to_trough"),
        F.date_diff("recovery_date", "peak_date").alias("days_to_recovery"),
    )
