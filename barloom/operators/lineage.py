"""Dimension rows and the lineage columns every published measure table carries."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Published columns in order.
DIMENSION_COLUMNS = ("bank_name", "short_name")
LINEAGE_COLUMNS = ("source_run_id", "source_ingested_at", "pipeline_run_id", "built_at")


def dimension(universe: DataFrame, entity: str = "ticker") -> DataFrame:
    return universe.select(F.col("ticker").alias(entity), *DIMENSION_COLUMNS)


def source_lineage(panel: DataFrame) -> DataFrame:
    """One row: how many source runs the rows come from (a missing id counts as one), which, and their latest time."""
    return panel.agg(
        (F.count_distinct("source_run_id") + F.bool_or(F.col("source_run_id").isNull()).cast("int")).alias("n_runs"),
        F.min("source_run_id").alias("source_run_id"),
        F.max("source_ingested_at").alias("source_ingested_at"),
    )


def with_lineage(
    frame: DataFrame,
    source_run_id: str | None,
    source_ingested_at: datetime.datetime | None,
    pipeline_run_id: str,
    built_at: datetime.datetime,
) -> DataFrame:
    """Append the lineage columns. ``built_at`` is fixed by the caller, so every table of a run shares one value."""
    return frame.withColumns(
        {
            "source_run_id": F.lit(source_run_id).cast("string"),
            "source_ingested_at": F.lit(source_ingested_at).cast("timestamp"),
            "pipeline_run_id": F.lit(pipeline_run_id),
            "built_at": F.lit(built_at).cast("timestamp"),
        }
    )
