"""Bars of longer periods held against daily bars, where a label does not stand for the days it names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.spec import PRICE_TOLERANCE, PanelSpec

#: What is compared, and in this order a difference is named.
FIELDS = ("open", "high", "low", "close", "volume")


def week_after(label: Column) -> tuple[Column, Column]:
    """A weekly label covers the seven days after it."""
    return F.date_add(label, 1), F.date_add(label, 7)


def month_after(label: Column) -> tuple[Column, Column]:
    """A monthly label, the last day of a month, covers the month that follows."""
    return F.date_add(label, 1), F.last_day(F.date_add(label, 1))


def covered_days(daily: DataFrame, coarse: DataFrame, covers, bin_days: int, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """The daily bars with the ``label`` of each coarse bar that covers them, null for days of no label.

    A join on ranges by bins: calendar days are cut into bins of ``bin_days``, a label stands in every bin that its days
    touch (two, if a bin is no shorter than a period), a day in its own, and the two meet on entity and bin, so that no
    day is compared with labels of other bins."""
    first, last = covers(F.col("label"))
    day, bin_of = F.col(spec.date), lambda d: F.floor(F.unix_date(d) / bin_days)
    spans = coarse.select(spec.entity, "label", first.alias("first_day"), last.alias("last_day"))
    spans = spans.withColumn("bin", F.explode(F.sequence(bin_of("first_day"), bin_of("last_day")))).alias("s")
    days = daily.select(*spec.key, *FIELDS, bin_of(spec.date).alias("bin")).alias("d")
    same_bin = (F.col(f"d.{spec.entity}") == F.col(f"s.{spec.entity}")) & (F.col("d.bin") == F.col("s.bin"))
    within = day.between(F.col("s.first_day"), F.col("s.last_day"))
    return days.join(spans, same_bin & within, "left").select("d.*", "s.label").drop("bin")


def reconcile_bars(
    daily: DataFrame, coarse: DataFrame, covers, bin_days: int, spec: PanelSpec = PanelSpec(), tolerance: float = PRICE_TOLERANCE
) -> DataFrame:
    """Coarse bars (entity, ``label``, open, high, low, close, volume) against those made of the daily bars that each
    label covers: (entity, label, n_sessions, one column ``<field>_differs`` each, ``difference``), one row per label, and
    one with a null label per entity that has days of no label.

    ``difference`` lists the fields that differ, joined by commas; ``no daily bars`` for a label that covers none,
    ``no label`` for days of none, empty for a match. A value that is null on one side only differs. Prices match within
    ``tolerance``, volumes exactly. Repeated coarse bars of a label are each held against the days on their own."""
    day = F.col(spec.date)
    of_days = (
        covered_days(daily, coarse.select(spec.entity, "label").distinct(), covers, bin_days, spec)
        .groupBy(spec.entity, "label")
        .agg(
            F.count("*").alias("n_sessions"),
            F.min_by("open", day).alias("d_open"),
            F.max("high").alias("d_high"),
            F.min("low").alias("d_low"),
            F.max_by("close", day).alias("d_close"),
            F.sum("volume").alias("d_volume"),
        )
    )
    given = coarse.select(spec.entity, "label", *FIELDS, F.lit(True).alias("given"))
    both = of_days.withColumnRenamed(spec.entity, "e").withColumnRenamed("label", "l")
    joined = given.join(both, (F.col(spec.entity) == F.col("e")) & (F.col("label") == F.col("l")), "full")

    def differs(field: str) -> Column:
        mine, theirs = F.col(field), F.col(f"d_{field}")
        same = mine == theirs if field == "volume" else F.abs(mine - theirs) <= tolerance
        return ~F.coalesce(same, mine.isNull() & theirs.isNull())

    named = [F.when(F.col(f"{f}_differs"), F.lit(f)) for f in FIELDS]
    kind = (
        F.when(F.col("given").isNull(), "no label")
        .when(F.col("n_sessions").isNull(), "no daily bars")
        .otherwise(F.concat_ws(",", *named))
    )
    compared = reduce(lambda frame, f: frame.withColumn(f"{f}_differs", F.col("given") & F.col("n_sessions").isNotNull() & differs(f)), FIELDS, joined)
    return compared.select(
        F.coalesce(spec.entity, "e").alias(spec.entity),
        "label",
        F.coalesce("n_sessions", F.lit(0)).alias("n_sessions"),
        *[F.coalesce(f"{f}_differs", F.lit(False)).alias(f"{f}_differs") for f in FIELDS],
        kind.alias("difference"),
    )
