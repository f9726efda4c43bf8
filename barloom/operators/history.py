"""Many versions of one table as rows with the versions they held in, and what was restated between versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of a history beside those of the table. ``valid_to`` is the first version without the row, null if there is none.
HISTORY_COLUMNS = ("copies", "valid_from", "valid_to")


def fold_versions(versions: list[DataFrame]) -> DataFrame:
    """The columns that all versions share, ``copies``, ``valid_from`` and ``valid_to``: one row per row content and
    stretch of versions that hold it in the same number of copies. Versions count from 0 in the order given.

    Rows are stacked with their version and grouped by their whole content once, with a count per version, which combines
    copies before the only shuffle. The counts of a content tell its stretches: one begins where the number is another
    than in the version before, and ends where the next other number stands. A key needs no name: a changed row is one
    content that ends and another that begins.
    """
    shared = [c for c in versions[0].columns if all(c in v.columns for v in versions)]
    stacked = reduce(
        DataFrame.unionByName, [v.select(*shared).withColumn("_version", F.lit(i)) for i, v in enumerate(versions)]
    )
    held = [F.count_if(F.col("_version") == i).alias(f"_n{i}") for i in range(len(versions))]
    counted = stacked.groupBy(*shared).agg(*held).select(*shared, F.array(*[f"_n{i}" for i in range(len(versions))]).alias("_n"))
    n, places = F.col("_n"), F.array(*[F.lit(i) for i in range(len(versions))])

    def begins(at: Column) -> Column:
        return (F.get(n, at) > 0) & ~F.get(n, at).eqNullSafe(F.get(n, at - 1))

    def stretch(at: Column) -> Column:
        end = F.array_min(F.filter(places, lambda later: (later > at) & (F.get(n, later) != F.get(n, at))))
        return F.struct(F.get(n, at).alias("copies"), at.alias("valid_from"), end.alias("valid_to"))

    return counted.select(*shared, F.inline(F.transform(F.filter(places, begins), stretch)))


def as_of(history: DataFrame, version: int) -> DataFrame:
    """The table as it was in a version, every copy of a row included."""
    held = history.where((F.col("valid_from") <= version) & (F.col("valid_to").isNull() | (F.col("valid_to") > version)))
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return held.withColumn("_copy", copy).drop("_copy", *HISTORY_COLUMNS)


def restatements(history: DataFrame, keys: list[str], before: int, after: int) -> DataFrame:
    """One row per key that two versions do not agree on: keys, ``change`` (added, removed, changed) and ``columns``, those
    that differ, joined by commas; ``copies`` among them if a content is held more or fewer times.

    Only contents that hold in one of the two versions alone, or in another number, are read any further, so what was
    not restated never reaches the grouping. Of a key with several contents on a side the extremes are compared."""
    values = [c for c in history.columns if c not in keys and c not in ("valid_from", "valid_to")]

    def holds(version: int):
        return (F.col("valid_from") <= version) & (F.col("valid_to").isNull() | (F.col("valid_to") > version))

    moved = history.where(holds(before) != holds(after)).withColumn("_before", holds(before))
    grouped = moved.groupBy(*keys).agg(
        F.count_if("_before").alias("n_before"),
        F.count_if(~F.col("_before")).alias("n_after"),
        *[agg(F.when(F.col("_before"), F.struct(c))).alias(f"b_{c}_{i}") for c in values for i, agg in enumerate((F.min, F.max))],
        *[agg(F.when(~F.col("_before"), F.struct(c))).alias(f"a_{c}_{i}") for c in values for i, agg in enumerate((F.min, F.max))],
    )
    differs = [F.when(~(F.col(f"b_{c}_0").eqNullSafe(F.col(f"a_{c}_0")) & F.col(f"b_{c}_1").eqNullSafe(F.col(f"a_{c}_1"))), F.lit(c)) for c in values]
    change = F.when(F.col("n_before") == 0, "added").when(F.col("n_after") == 0, "removed").otherwise("changed")
    named = F.when(change == "changed", F.concat_ws(",", *differs)).otherwise("")
    return grouped.select(*keys, change.alias("change"), named.alias("columns"))


def restated_per_version(history: DataFrame, keys: list[str], n_versions: int) -> DataFrame:
    """(version, n_added, n_removed, n_changed): keys that each version restates of the one before it, from the borders of
    the stretches alone, taken in one pass; versions that restate nothing have a row of zeros."""
    borders = F.array_compact(
        F.array(
            F.when(F.col("valid_from") > 0, F.struct(F.col("valid_from").alias("version"), F.lit(1).alias("began"), F.lit(0).alias("ended"))),
            F.when(F.col("valid_to").isNotNull(), F.struct(F.col("valid_to").alias("version"), F.lit(0).alias("began"), F.lit(1).alias("ended"))),
        )
    )
    by_key = history.select(*keys, F.inline(borders)).groupBy(*keys, "version").agg(F.max("began").alias("began"), F.max("ended").alias("ended"))
    counts = by_key.groupBy("version").agg(
        F.count_if(F.expr("began = 1 AND ended = 0")).alias("n_added"),
        F.count_if(F.expr("began = 0 AND ended = 1")).alias("n_removed"),
        F.count_if(F.expr("began = 1 AND ended = 1")).alias("n_changed"),
    )
    versions = history.sparkSession.range(1, n_versions).select(F.col("id").cast("int").alias("version"))
    return versions.join(counts, "version", "left").na.fill(0)
