"""Snapshot comparison in two stages: checksums per bucket of keys, written when a snapshot is published, tell which
buckets differ, and only the rows of those are compared by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from barloom.operators.diff import BUCKETS, RUN_COLUMNS, hash_sums, key_bucket, snapshot_diff
from barloom.session import local_rows

SUMS_SCHEMA = "bucket INT, n_rows BIGINT, n_twice BIGINT, digest DECIMAL(38,0)"


def _digest() -> Column:
    return (F.col("high").cast("decimal(38,0)") * F.lit(2**32).cast("decimal(10,0)") + F.col("low")).cast("decimal(38,0)").alias("digest")


def bucket_checksums(
    table: DataFrame, keys: list[str], exclude: tuple[str, ...] = RUN_COLUMNS, buckets: int = BUCKETS, known: DataFrame | None = None
) -> DataFrame:
    """(bucket, n_rows, n_twice, digest): rows, keys held more than once, and a sum of row hashes, which does not depend on
    the order of the rows nor on how they are dealt. Columns are taken by name, nulls have a hash of their own.

    Keys are grouped once, copies combined before the shuffle; the result has a row per bucket, however large the
    table. Written next to a snapshot, it is all that a comparison of equal snapshots reads. With ``known``, the
    checksums of a version before, the sums are taken where the rows are and only the keys of buckets that are not in
    ``known`` with the same rows are grouped; in the others as many keys are held more than once as there."""
    columns, bucket = [c for c in table.columns if c not in exclude], key_bucket(keys, buckets)
    if known is None:
        by_key = table.groupBy(*keys).agg(F.count("*").alias("n"), *hash_sums(columns))
        return by_key.groupBy(bucket.alias("bucket")).agg(
            F.sum("n").alias("n_rows"), F.count_if(F.col("n") > 1).alias("n_twice"), F.sum("high").alias("high"), F.sum("low").alias("low")
        ).select("bucket", "n_rows", "n_twice", _digest())
    sums = table.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n_rows"), *hash_sums(columns)).select("bucket", "n_rows", _digest())
    # A row per bucket, a parameter.
    told = {r["bucket"]: r for r in sums.join(known.select("bucket", "n_rows", "digest", "n_twice"), ["bucket", "n_rows", "digest"], "left").collect()}
    fresh = sorted(b for b, r in told.items() if r["n_twice"] is None)
    twice = {}
    if fresh:
        by_key = table.where(bucket.isin(fresh)).groupBy(*keys).agg(F.count("*").alias("n"))
        twice = {r["bucket"]: r["n"] for r in by_key.groupBy(bucket.alias("bucket")).agg(F.count_if(F.col("n") > 1).alias("n")).collect()}
    rows = [(b, r["n_rows"], twice.get(b, r["n_twice"]), r["digest"]) for b, r in sorted(told.items())]
    return local_rows(table.sparkSession, rows, SUMS_SCHEMA)


def _compared(previous: DataFrame, latest: DataFrame) -> list[Row]:
    """(bucket, differs, n_rows, n_twice) per bucket, the counts those of the latest side; there are at most as many as
    buckets, a parameter."""
    sides = previous.withColumn("side", F.lit(-1)).unionByName(latest.withColumn("side", F.lit(1)))

    def balance(column: str) -> Column:
        return F.sum(F.col("side") * F.col(column)) != 0

    of_latest = {c: F.coalesce(F.sum(F.when(F.col("side") == 1, F.col(c))), F.lit(0)) for c in ("n_rows", "n_twice")}
    differs = (balance("n_rows") | balance("n_twice") | balance("digest")).alias("differs")
    return sides.groupBy("bucket").agg(differs, *[n.alias(c) for c, n in of_latest.items()]).collect()


def differing_buckets(previous: DataFrame, latest: DataFrame) -> list[int]:
    """Buckets whose checksums are not the same."""
    return sorted(r["bucket"] for r in _compared(previous, latest) if r["differs"])


def two_stage_diff(
    previous: DataFrame,
    latest: DataFrame,
    previous_sums: DataFrame,
    latest_sums: DataFrame,
    keys: list[str],
    exclude: tuple[str, ...] = RUN_COLUMNS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The metrics of ``snapshot_diff`` from two tables and their checksums. Rows of equal buckets are counted from the
    checksums and not read; if all are equal, no row is. A bucket in which a double differs in its last bits is compared
    by key like any other, so the tolerance of doubles is that of ``snapshot_diff``. Tables with other columns are
    compared whole. Two different buckets pass as equal with a chance of about one in 2**64."""
    compared = [c for c in latest.columns if c not in exclude]
    if sorted(compared) != sorted(c for c in previous.columns if c not in exclude):
        return snapshot_diff(previous, latest, keys, exclude)
    told = _compared(previous_sums, latest_sums)
    differing = sorted(r["bucket"] for r in told if r["differs"])
    same_rows, same_twice = (sum(r[c] for r in told if not r["differs"]) for c in ("n_rows", "n_twice"))
    here = key_bucket(keys, buckets).isin(differing) if differing else F.lit(False)
    rest = snapshot_diff(previous.where(here), latest.where(here), keys, exclude, judged=True)
    types = dict(latest.dtypes)
    doubles = any(types[c] in ("double", "float") for c in compared if c not in keys)
    none = F.lit(0.0) if doubles and same_rows else F.lit(None).cast("double")
    return rest.select(
        (F.col("rows_prev") + same_rows).alias("rows_prev"),
        (F.col("rows_latest") + same_rows).alias("rows_latest"),
        (F.col("dup_keys") + same_twice).alias("dup_keys"),
        "missing_rows",
        "mismatched_non_double",
        F.greatest("max_double_diff", none).alias("max_double_diff"),
        "note",
    )
