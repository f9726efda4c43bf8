"""The measure tables as serving wants them: bucketed by entity and sorted, so that joins of facts with the dimension
move nothing, and filters on entity and date leave out buckets and row groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files per table; a bucket of a table of 100 TB then has about 25 GB in files of its own.
BUCKETS = 64
#: Rows of a Parquet row group are written until it has so many bytes; small ones can be left out one by one.
ROW_GROUP_BYTES = 8 << 20


def store_bucketed(
    table: DataFrame, name: str, path: str, order: list[str], entity: str = "ticker", buckets: int = BUCKETS,
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """Write ``table`` as ``name``, bucketed by ``entity`` and sorted by ``order`` within a bucket. Rows are dealt to the
    buckets by one shuffle, so each bucket is one file; tables with the same number of buckets join without another."""
    (
        table.repartition(buckets, F.col(entity))
        .write.format("parquet")
        .mode("overwrite")
        .option("path", path)
        .option("parquet.block.size", row_group_bytes)
        .bucketBy(buckets, entity)
        .sortBy(*order)
        .saveAsTable(name)
    )


def store_for_serving(
    spark: SparkSession, tables: dict[str, DataFrame], schema: str, folder: str, buckets: int = BUCKETS, **options
) -> dict[str, DataFrame]:
    """Every table bucketed below ``folder`` and named in ``schema``; sorted by entity and its date, month or year."""
    out = {}
    for name, table in tables.items():
        order = ["ticker", *[c for c in ("trade_date", "month_start", "year") if c in table.columns][:1]]
        store_bucketed(table, f"{schema}.{name}", f"{folder}/{name}", order, buckets=buckets, **options)
        out[name] = spark.table(f"{schema}.{name}")
    return out
