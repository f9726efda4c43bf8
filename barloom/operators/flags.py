"""Trading-day flags read from the data, the common base date, and the checks on days without trade."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.columns import holds, within
from barloom.operators.series import SeriesSplit
from barloom.spec import NORMAL, PRICE_TOLERANCE, ZERO_ALL, ZERO_PARTIAL, PanelSpec


def untraded_dates(panel: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Dates on which no entity has volume."""
    return (
        panel.groupBy(spec.date)
        .agg(F.bool_or(F.col("volume") > 0).alias("traded"))
        .filter(~F.col("traded"))
        .select(spec.date, F.lit(True).alias("_untraded"))
    )


def volume_status(panel: DataFrame, spec: PanelSpec = PanelSpec(), untraded: DataFrame | None = None) -> DataFrame:
    """Add ``volume_status``: normal, or which kind of day without volume this is. ``untraded`` are the panel's
    ``untraded_dates``, where they are stored already.

    A date can hold a large share of the panel, so the per-date fact is a grouped aggregate (combined before its
    shuffle). Only the untraded dates come back: the calendar bounds them, however large the panel, so they are sent to
    its rows. The planner does not know how few they are before the panel has been moved to meet them.
    """
    untraded = untraded_dates(panel, spec) if untraded is None else untraded
    return (
        panel.join(F.broadcast(untraded), spec.date, "left")
        .withColumn(
            "volume_status",
            F.when(F.col("volume") > 0, NORMAL).when(F.col("_untraded"), ZERO_ALL).otherwise(ZERO_PARTIAL),
        )
        .drop("_untraded")
    )


def base_date(panel: DataFrame, n_entities: int | Column, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """One row, ``base_date``: the first date on which enough entities (by default all) are normal; NULL if none."""
    n_entities = F.lit(n_entities) if isinstance(n_entities, int) else n_entities
    needed = F.ceil(n_entities * F.lit(spec.min_coverage))
    return (
        panel.groupBy(spec.date)
        .agg(F.count_if(F.col("volume_status") == NORMAL).alias("n_normal"))
        .filter(F.col("n_normal") >= needed)
        .agg(F.min(spec.date).alias("base_date"))
    )


def base_date_value(panel: DataFrame, n_entities: int, spec: PanelSpec = PanelSpec()) -> datetime.date | None:
    return base_date(panel, n_entities, spec).first()["base_date"]


def key_profile(panel: DataFrame, spec: PanelSpec = PanelSpec(), split: SeriesSplit | None = None) -> DataFrame:
    """One row per key: ``copies``, what its zero-volume rows look like, and the values on the entity's previous date
    (``prev_close``, ``prev_adjclose``).

    Copies of a key are merged first, in a grouped aggregate, so the window holds one row per entity and day even on
    input that still contains duplicates. With ``split`` it holds one block of days, and a block's first row looks up
    the last bar of the blocks before it in the small table of block ends.
    """
    is_zero = F.col("volume") == 0
    one_price = _same("open", "high") & _same("high", "low") & _same("low", "close")
    flat_close, zero_adj = F.when(is_zero & one_price, F.col("close")), F.when(is_zero, F.col("adjclose"))
    merged = panel.groupBy(*spec.key).agg(
        F.count("*").alias("copies"),
        F.max("close").alias("close"),
        F.max("adjclose").alias("adjclose"),
        F.count_if(is_zero).alias("n_zero"),
        F.count(flat_close).alias("n_one_price"),
        F.min(flat_close).alias("least_close"),
        F.max(flat_close).alias("most_close"),
        F.min(zero_adj).alias("least_adj"),
        F.max(zero_adj).alias("most_adj"),
    )
    bar = F.struct(F.col(spec.date).alias("day"), "close", "adjclose")
    if split is None:
        series = Window.partitionBy(spec.entity).orderBy(spec.date)
        looked_up = merged.withColumn("_before", F.lag(bar).over(series))
    else:
        blocked = merged.withColumn("_block", split.block(spec))
        ends = blocked.groupBy(spec.entity, "_block").agg(F.max(bar).alias("_end"))
        blocks = Window.partitionBy(spec.entity).orderBy("_block")
        before = ends.select(spec.entity, "_block", F.lag("_end").over(blocks).alias("_earlier"))
        inside = Window.partitionBy(spec.entity, "_block").orderBy(spec.date)
        looked_up = (
            blocked.withColumn("_lag", F.lag(bar).over(inside))
            .join(before, [spec.entity, "_block"])
            .withColumn("_before", F.coalesce("_lag", "_earlier"))
        )
    return looked_up.withColumn("prev_close", F.col("_before.close")).withColumn(
        "prev_adjclose", F.col("_before.adjclose")
    )


def entity_profile(panel: DataFrame, spec: PanelSpec = PanelSpec(), split: SeriesSplit | None = None) -> DataFrame:
    """One row per entity: its dates, its duplicated keys, and how many zero-volume rows are not flat or not carried.

    Copies of a key are merged before anything moves by entity, so an entity that is flooded with them, which is what
    this profile must find, sends one row a day to its window.

    A key whose copies differ in price counts all of its flat rows as moved if one of them is; such a panel stops at the
    duplicate check anyway.
    """

    def moved(least: str, most: str, before: str) -> Column:
        return holds(~_same(least, before) | ~_same(most, before))

    close_moved = moved("least_close", "most_close", "prev_close")
    adj_moved = moved("least_adj", "most_adj", "prev_adjclose")
    not_flat = F.col("n_zero") - F.col("n_one_price") + F.when(close_moved, F.col("n_one_price")).otherwise(0)
    duplicated = F.col("copies") > 1
    needed = panel.select(*spec.key, "open", "high", "low", "close", "adjclose", "volume")
    return (
        key_profile(needed, spec, split)
        .groupBy(spec.entity)
        .agg(
            F.count("*").alias("n_dates"),
            F.count_if(duplicated).alias("n_duplicated"),
            F.sum(not_flat).alias("n_not_flat"),
            F.sum(F.when(adj_moved, F.col("n_zero")).otherwise(0)).alias("n_not_carried"),
        )
    )


def _same(left: str, right: str) -> Column:
    return within(F.col(left), F.col(right), PRICE_TOLERANCE)


def zero_volume_rows(
    panel: DataFrame, spec: PanelSpec = PanelSpec(), split: SeriesSplit | None = None
) -> DataFrame:
    """The rows without volume, each with the previous bar and the two verdicts ``is_flat`` and ``is_carried``.

    ``is_flat``: open, high, low and close agree with each other and with the previous close.
    ``is_carried``: the adjusted close repeats the previous one. An entity's first row has no previous bar to agree with.
    Only keys that have such a row reach the join.
    """

    before = key_profile(panel, spec, split).filter("n_zero > 0").select(*spec.key, "prev_close", "prev_adjclose")
    zero = panel.filter(F.col("volume") == 0).join(before, spec.key, "left")
    one_price = _same("open", "high") & _same("high", "low") & _same("low", "close")
    return zero.withColumn(
        "is_flat", one_price & (F.col("prev_close").isNull() | _same("close", "prev_close"))
    ).withColumn("is_carried", F.col("prev_adjclose").isNull() | _same("adjclose", "prev_adjclose"))


def zero_volume_not_flat(
    panel: DataFrame, spec: PanelSpec = PanelSpec(), split: SeriesSplit | None = None
) -> DataFrame:
    return zero_volume_rows(panel, spec, split).filter(~holds(F.col("is_flat"))).drop("is_flat", "is_carried")


def adjclose_not_carried(
    panel: DataFrame, spec: PanelSpec = PanelSpec(), split: SeriesSplit | None = None
) -> DataFrame:
    return zero_volume_rows(panel, spec, split).filter(~holds(F.col("is_carried"))).drop("is_flat", "is_carried")
