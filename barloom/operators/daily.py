"""Daily measures: index, gap-skipping return, rolling volatility, running peak, drawdown, relative volume."""

from __future__ import annotations

import datetime
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.series import SeriesSplit
from barloom.spec import NORMAL, PanelSpec

# Published columns in order. ``running_peak_date`` is a working column the summary needs.
DAILY_COLUMNS = (
    "close", "adjclose", "volume", "volume_status", "normalized_index", "daily_return", "vol_60d_ann",
    "running_peak", "drawdown", "rel_volume_60d", "year", "month",
)
WORKING_COLUMNS = ("running_peak_date",)


def as_date(base: datetime.date | Column) -> Column:
    """A base date is either a known date or a scalar subquery, which keeps a whole query lazy."""
    return base if isinstance(base, Column) else F.lit(base)


def daily_metrics(
    panel: DataFrame,
    base: datetime.date | Column,
    spec: PanelSpec = PanelSpec(),
    split: SeriesSplit | None = None,
) -> DataFrame:
    """One row per bar from the base date on.

    Returns, volatility and relative volume count normal rows only, so their windows run over like rows (same
    ``is_normal``) and flagged rows get NULL, without filtering and joining back. The running maximum carries the date
    it was set, which gives the peak date later.

    Without ``split`` the panel moves once, by entity: the windows over like rows are satisfied by that partitioning.
    """
    base = as_date(base)
    bars = (
        panel.filter(F.col(spec.date) >= base)
        .select(*spec.key, "close", "adjclose", "volume", "volume_status")
        .withColumn("is_normal", F.col("volume_status") == NORMAL)
    )
    if split is None:
        placed = _whole_series(bars, spec)
        measured = _like_row_measures(placed, [spec.entity, "is_normal"], spec)
    else:
        placed = _blocks_of_days(bars, spec, split)
        measured = _like_row_measures(
            _chunks_of_like_rows(placed, spec, split), [spec.entity, "is_normal", "_chunk"], spec
        ).filter("_own")
    base_adjclose = F.when(F.col("_first.day") == base, F.col("_first.adjclose"))
    return (
        measured.withColumn("normalized_index", 100 * F.col("adjclose") / base_adjclose)
        .withColumn("running_peak", F.col("_peak.adjclose"))
        .withColumn("running_peak_date", F.date_from_unix_date(-F.col("_peak.negated_day")))
        .withColumn("drawdown", F.col("adjclose") / F.col("running_peak") - 1)
        .withColumn("year", F.year(spec.date))
        .withColumn("month", F.month(spec.date))
        .select(*spec.key, *DAILY_COLUMNS, *WORKING_COLUMNS)
    )


def _priced_day(spec: PanelSpec) -> Column:
    """A larger struct is a higher price, or the same price on an earlier date."""
    return F.struct(F.col("adjclose"), (-F.unix_date(spec.date)).alias("negated_day"))


def _first_bar(spec: PanelSpec) -> Column:
    return F.struct(F.col(spec.date).alias("day"), F.col("adjclose"))


def _whole_series(bars: DataFrame, spec: PanelSpec) -> DataFrame:
    """Add ``_peak`` (highest priced day so far) and ``_first`` (the entity's first bar)."""
    series = Window.partitionBy(spec.entity).orderBy(spec.date)
    so_far = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return bars.withColumn("_peak", F.max(_priced_day(spec)).over(so_far)).withColumn(
        "_first", F.first(_first_bar(spec)).over(so_far)
    )


def _like_row_measures(placed: DataFrame, partition: list[str], spec: PanelSpec) -> DataFrame:
    like_rows = Window.partitionBy(*partition).orderBy(spec.date)
    last_returns = like_rows.rowsBetween(1 - spec.vol_window, Window.currentRow)
    earlier_volume = like_rows.rowsBetween(-spec.rel_volume_window, -1)

    def if_normal(value: Column) -> Column:
        return F.when(F.col("is_normal"), value)

    returns = placed.withColumn(
        "daily_return", if_normal(F.col("adjclose") / F.lag("adjclose").over(like_rows) - 1)
    )
    return returns.select(
        "*",
        if_normal(
            F.when(
                F.count("daily_return").over(last_returns) == spec.vol_window,
                F.stddev_samp("daily_return").over(last_returns) * math.sqrt(spec.annualization),
            )
        ).alias("vol_60d_ann"),
        if_normal(
            F.when(
                F.count("volume").over(earlier_volume) == spec.rel_volume_window,
                F.col("volume") / F.avg("volume").over(earlier_volume),
            )
        ).alias("rel_volume_60d"),
    )


def _blocks_of_days(bars: DataFrame, spec: PanelSpec, split: SeriesSplit) -> DataFrame:
    """``_peak`` and ``_first`` as above, and ``_position``, the row's number among the entity's like rows.

    Each block of days works alone. What the blocks before it contribute is a grouped aggregate with one row per entity
    and block, accumulated by entity; it joins back on the partitioning the blocks already have.
    """
    blocked = bars.withColumn("_block", split.block(spec))
    totals = blocked.groupBy(spec.entity, "_block").agg(
        F.max(_priced_day(spec)).alias("top"),
        F.min(_first_bar(spec)).alias("first"),
        F.count_if("is_normal").alias("n_normal"),
        F.count_if(~F.col("is_normal")).alias("n_flagged"),
    )
    blocks = Window.partitionBy(spec.entity).orderBy("_block")
    earlier = blocks.rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        spec.entity,
        "_block",
        F.max("top").over(earlier).alias("_peak_before"),
        F.first("first").over(blocks.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_first"),
        F.coalesce(F.sum("n_normal").over(earlier), F.lit(0)).alias("_normal_before"),
        F.coalesce(F.sum("n_flagged").over(earlier), F.lit(0)).alias("_flagged_before"),
    )
    inside = Window.partitionBy(spec.entity, "_block").orderBy(spec.date)
    like_inside = Window.partitionBy(spec.entity, "_block", "is_normal").orderBy(spec.date)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        blocked.withColumn("_peak_inside", F.max(_priced_day(spec)).over(so_far))
        .withColumn("_n_inside", F.row_number().over(like_inside))
        .join(carried, [spec.entity, "_block"])
        .withColumn("_peak", F.greatest("_peak_inside", "_peak_before"))
        .withColumn(
            "_position",
            F.col("_n_inside") + F.when(F.col("is_normal"), F.col("_normal_before")).otherwise(F.col("_flagged_before")),
        )
    )


def _chunks_of_like_rows(placed: DataFrame, spec: PanelSpec, split: SeriesSplit) -> DataFrame:
    """Cut each entity's like rows into chunks of a fixed number of rows. The last rows of a chunk are also sent to the
    next one, as many as the longest frame looks back, so every frame is complete within its row's own chunk."""
    reach = max(spec.vol_window, spec.rel_volume_window)
    if split.chunk_rows < reach:
        raise ValueError(f"chunk_rows must be at least {reach}, the reach of the windows")
    before = F.col("_position") - 1
    own = F.floor(before / split.chunk_rows)
    in_tail = F.col("is_normal") & (before % split.chunk_rows >= split.chunk_rows - reach)
    targets = F.when(in_tail, F.array(own, own + 1)).otherwise(F.array(own))
    return placed.withColumn("_own_chunk", own).select("*", F.explode(targets).alias("_chunk")).withColumn(
        "_own", F.col("_chunk") == F.col("_own_chunk")
    )
