"""Fault injection for tests: overwrite one bar with a copy of the one before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def replace_row_with_previous(frame: DataFrame, entity: str, order: str, target: str, row_number: int) -> DataFrame:
    """Row ``row_number`` (from 1, in ``order``) of one entity becomes a copy of the row before it.

    The row count stays the same and exactly one key is duplicated, so a per-entity count check does not see it. Only
    the target entity's rows are moved; all others pass through.
    """
    mine = F.col(entity).eqNullSafe(F.lit(target))
    n_rows = frame.filter(mine).count()
    if not 2 <= row_number <= n_rows:
        raise ValueError(f"row_number must lie in 2..{n_rows}, got {row_number}")
    series = Window.partitionBy(entity).orderBy(order)
    whole_row = F.struct(*frame.columns)
    edited = (
        frame.filter(mine)
        .select(
            whole_row.alias("own"),
            F.lag(whole_row).over(series).alias("before"),
            F.row_number().over(series).alias("n"),
        )
        .select(F.when(F.col("n") == row_number, F.col("before")).otherwise(F.col("own")).alias("kept"))
        .select("kept.*")
    )
    return frame.filter(~mine).unionByName(edited)
