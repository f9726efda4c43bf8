"""Key-based comparison of two snapshots of one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Doubles from grouped aggregates may differ in their last bits between runs.
DOUBLE_TOLERANCE = 1e-9

# Columns that change on every run.
RUN_COLUMNS = (
    "pipeline_run_id", "bronze_pipeline_run_id", "bronze_loaded_at", "processed_at", "quarantined_at", "built_at",
)

#: Into how many parts the keys of a table are dealt, of which each has a checksum.
BUCKETS = 1024

METRICS_SCHEMA = (
    "rows_prev BIGINT, rows_latest BIGINT, dup_keys BIGINT, missing_rows BIGINT, mismatched_non_double BIGINT, "
    "max_double_diff DOUBLE, note STRING"
)


def verdict(tolerance: float = DOUBLE_TOLERANCE) -> Column:
    """PASS / FAIL over the columns of ``snapshot_diff``; a counts-only comparison has NULL in the keyed ones."""
    clean = (
        (F.col("note") == "")
        & F.col("rows_prev").eqNullSafe(F.col("rows_latest"))
        & (F.coalesce("dup_keys", F.lit(0)) == 0)
        & (F.coalesce("missing_rows", F.lit(0)) == 0)
        & (F.coalesce("mismatched_non_double", F.lit(0)) == 0)
        & (F.coalesce("max_double_diff", F.lit(0.0)) <= tolerance)
    )
    return F.when(clean, "PASS").otherwise("FAIL")


def _column_note(previous: DataFrame, latest: DataFrame, exclude: tuple[str, ...]) -> str:
    """Columns that one side alone has, each marked with its side; empty if there are none."""
    sides = {"-": (previous, latest), "+": (latest, previous)}
    marked = [
        sign + column
        for sign, (here, there) in sides.items()
        for column in sorted(here.columns)
        if column not in exclude and column not in there.columns
    ]
    return f"other columns: {' '.join(marked)}" if marked else ""


def _row_counts(previous: DataFrame, latest: DataFrame) -> DataFrame:
    sides = previous.select(F.lit(0).alias("side")).unionByName(latest.select(F.lit(1).alias("side")))
    return sides.agg(
        F.count_if(F.col("side") == 0).alias("rows_prev"),
        F.count_if(F.col("side") == 1).alias("rows_latest"),
        F.lit(None).cast("bigint").alias("dup_keys"),
        F.lit(None).cast("bigint").alias("missing_rows"),
        F.lit(None).cast("bigint").alias("mismatched_non_double"),
        F.lit(None).cast("double").alias("max_double_diff"),
    )


def key_bucket(keys: list[str], buckets: int = BUCKETS) -> Column:
    marks = [part for k in keys for part in (F.col(k), F.col(k).isNull())]
    return F.pmod(F.xxhash64(*marks), F.lit(buckets)).cast("int")


def hash_sums(columns: list[str]) -> list[Column]:
    """Aggregates ``high`` and ``low``: the two halves of a hash of the columns, summed over the rows in any order. Columns
    are taken by name, nulls have a hash of their own. The halves stay whole numbers, which a sum of hashes would not."""
    row = F.xxhash64(*[part for c in sorted(columns) for part in (F.lit(c), F.col(c), F.col(c).isNull())])
    return [F.sum(F.shiftright(row, 32)).alias("high"), F.sum(row.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low")]


def _equal_buckets(previous: DataFrame, latest: DataFrame, keys: list[str], shared: list[str], doubles: list[str]) -> tuple[list[int], int]:
    """(buckets of keys that hold the same rows on both sides, how many rows these are of one side), from sums that only
    partial results are moved for. A bucket with a double that is not finite counts as different: its difference to
    itself is no number. There are at most as many as buckets, a parameter."""
    odd = F.lit(False)
    for c in doubles:
        odd = odd | F.coalesce(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(False))
    sides = previous.select(*shared, F.lit(1).alias("_side")).unionByName(latest.select(*shared, F.lit(-1).alias("_side")))
    sums = sides.groupBy(key_bucket(keys).alias("bucket"), "_side").agg(F.count("*").alias("n"), F.count_if(odd).alias("odd"), *hash_sums(shared))
    told = sums.groupBy("bucket").agg(
        F.max("n").alias("n"),
        (F.count("*") == 2).alias("both"),
        *[(F.min(c) == F.max(c)).alias(f"same_{c}") for c in ("n", "high", "low")],
        F.max("odd").alias("odd"),
    )
    same = told.where("both AND same_n AND same_high AND same_low AND odd = 0").select("bucket", "n").collect()
    return sorted(r["bucket"] for r in same), sum(r["n"] for r in same)


def snapshot_diff(
    previous: DataFrame, latest: DataFrame, keys: list[str] | None, exclude: tuple[str, ...] = RUN_COLUMNS, judged: bool = False
) -> DataFrame:
    """One row of comparison metrics. ``keys=None`` compares row counts only.

    Both sides are stacked and grouped by the key once (NULL keys match each other). Of each side a group keeps
    numbers only, which stays in hash aggregation and merges copies of a key before the shuffle: how many rows, the
    smallest and the largest hash of the exactly compared columns, the largest of each double. A key differs if the
    hashes of its sides do. NULL against a double counts as an infinite difference. A key with copies is compared by
    these extremes; such a table cannot pass, since copies in the latest side are counted, and copies in the previous
    side change the row or key counts.

    Checksums of key buckets, read first, tell which buckets hold the same rows on both sides. Of those only the keys of
    the latest side are grouped, to count the ones held more than once; there is nothing else to find, their rows of the
    previous side are not moved at all. Two different buckets pass as equal with a chance of about one in 2**64.
    ``judged`` says that the rows are of buckets known to differ.
    """
    note = _column_note(previous, latest, exclude)
    if keys is None:
        return _row_counts(previous, latest).withColumn("note", F.lit(""))

    shared = [c for c in latest.columns if c in previous.columns and c not in exclude]
    types = dict(latest.dtypes)
    doubles = [c for c in shared if c not in keys and types[c] in ("double", "float")]
    exact = [c for c in shared if c not in keys and c not in doubles]

    sides = (previous.withColumn("_side", F.lit(0)), latest.withColumn("_side", F.lit(1)))
    # A null has a hash of its own: it takes the place of the column and leaves a mark after it.
    marks = [part for c in exact for part in (F.col(c), F.col(c).isNull())]
    stacked = sides[0].select(*shared, "_side").unionByName(sides[1].select(*shared, "_side"))
    stacked = stacked.withColumn("_hash", F.xxhash64(*marks) if marks else F.lit(0).cast("bigint"))
    equal, equal_rows = ([], 0) if judged else _equal_buckets(previous, latest, keys, shared, doubles)
    if equal:
        same = key_bucket(keys).isin(equal)
        stacked = stacked.where(~(same & (F.col("_side") == 0))).withColumn("_same", same)
        stacked = stacked.withColumns({c: F.when(~F.col("_same"), F.col(c)) for c in ("_hash", *doubles)})
    else:
        stacked = stacked.withColumn("_same", F.lit(False))

    def of_side(side: int, value: Column) -> Column:
        return F.when(F.col("_side") == side, value)

    measures = []
    for side in (0, 1):
        measures += [
            F.count(of_side(side, F.lit(1))).alias(f"n{side}"),
            F.min(of_side(side, F.col("_hash"))).alias(f"low{side}"),
            F.max(of_side(side, F.col("_hash"))).alias(f"high{side}"),
            *[F.max(of_side(side, F.col(c))).alias(f"d{i}_{side}") for i, c in enumerate(doubles)],
        ]
    by_key = stacked.groupBy(*keys).agg(*measures, F.max("_same").alias("_same"))

    gaps = [
        F.coalesce(
            F.abs(F.col(f"d{i}_0") - F.col(f"d{i}_1")),
            F.when(F.col(f"d{i}_0").isNull() & F.col(f"d{i}_1").isNull(), 0.0).otherwise(float("inf")),
        )
        for i in range(len(doubles))
    ]
    widest = F.array_max(F.array(*gaps)) if gaps else F.lit(None).cast("double")
    in_both = (F.col("n0") > 0) & (F.col("n1") > 0)
    changed = (F.col("low0") != F.col("low1")) | (F.col("high0") != F.col("high1"))

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    none = F.when(F.lit(bool(equal and doubles)), 0.0)
    return by_key.agg(
        (total(F.col("n0")) + equal_rows).alias("rows_prev"),
        total(F.col("n1")).alias("rows_latest"),
        F.count_if(F.col("n1") > 1).alias("dup_keys"),
        total(F.when(~in_both & ~F.col("_same"), F.col("n0") + F.col("n1"))).alias("missing_rows"),
        F.count_if(in_both & changed).alias("mismatched_non_double"),
        F.greatest(F.max(F.when(in_both, widest)), none).alias("max_double_diff"),
    ).withColumn("note", F.lit(note))


def missing_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``left`` that ``right`` does not hold."""
    return left.select(*keys).distinct().join(right.select(*keys), keys, "left_anti")


def unmatched_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The symmetric difference of two key sets, labelled by the side that holds the key."""
    return (
        missing_keys(left, right, keys)
        .withColumn("held_by", F.lit("left"))
        .unionByName(missing_keys(right, left, keys).withColumn("held_by", F.lit("right")))
    )
