"""Rows that labels are learned from, and rows that are held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Resolution of a sampled share.
PARTS = 1_000_000


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(True))


def training_labels(labels: DataFrame, label: str, folds: int, fold: int, bound: int) -> DataFrame:
    """(doc_id, label) of rows that are not held out, one per id: the larger label if an id is repeated; null labels
    and ids are left out. Of more than ``bound`` rows, a share of about ``bound`` is taken by a hash of the id."""
    rows = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    n = max(1, rows.count())
    return rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)) < min(PARTS, PARTS * bound // n))
