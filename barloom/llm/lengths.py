"""Exact token counts for every context limit, from a histogram of encoded lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.scratch import Scratch

#: Lengths that are summed together before the running sums.
BLOCK = 1024


def length_histogram(lengths: DataFrame, length: str = "n_tokens") -> DataFrame:
    """(length, n_docs), one row per length that occurs, stored: the lengths are taken once, however often the histogram
    is read. Null lengths count as 0. Repeated rows count as often as they occur, other columns are ignored, an empty
    table gives no rows."""
    histogram = lengths.groupBy(F.coalesce(F.col(length), F.lit(0)).cast("bigint").alias("length")).agg(F.count("*").alias("n_docs"))
    return Scratch(lengths.sparkSession).store(histogram)


def merge_histograms(*histograms: DataFrame) -> DataFrame:
    """The histogram of several collections together."""
    both = histograms[0]
    for other in histograms[1:]:
        both = both.unionByName(other)
    return both.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def limit_table(histogram: DataFrame) -> DataFrame:
    """One row per length that occurs, read as a context limit.

    length, n_docs (of just this length), docs_longer (suffix sum), tokens_longer (tokens of the longer documents),
    n_total and tokens_total (of the collection), truncated_total (tokens left if every document is cut at the limit),
    tokens_lost, quantile (share of the documents that fit whole). An empty histogram gives no rows. Suffix sums are
    taken within blocks of lengths; only the blocks' totals are summed in one place.
    """
    blocked = histogram.withColumn("block", F.floor(F.col("length") / BLOCK))
    tokens = F.col("length") * F.col("n_docs")
    totals = blocked.groupBy("block").agg(F.sum("n_docs").alias("docs"), F.sum(tokens).alias("tokens"))
    beyond = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("bigint")
    totals = totals.select(
        "block",
        F.coalesce(F.sum("docs").over(beyond), zero).alias("docs_beyond"),
        F.coalesce(F.sum("tokens").over(beyond), zero).alias("tokens_beyond"),
        F.sum("docs").over(whole).alias("n_total"),
        F.sum("tokens").over(whole).alias("tokens_total"),
    )
    above = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    summed = blocked.withColumns(
        {"docs_above": F.coalesce(F.sum("n_docs").over(above), zero), "tokens_above": F.coalesce(F.sum(tokens).over(above), zero)}
    ).join(totals, "block")
    longer, their_tokens = F.col("docs_above") + F.col("docs_beyond"), F.col("tokens_above") + F.col("tokens_beyond")
    lost = their_tokens - F.col("length") * longer
    return summed.select(
        "length",
        "n_docs",
        longer.alias("docs_longer"),
        their_tokens.alias("tokens_longer"),
        "n_total",
        "tokens_total",
        (F.col("tokens_total") - lost).alias("truncated_total"),
        lost.alias("tokens_lost"),
        ((F.col("n_total") - longer) / F.col("n_total")).alias("quantile"),
    )


def totals_at(limits: DataFrame, histogram: DataFrame) -> DataFrame:
    """(limit, truncated_total, docs_cut) of every row of ``limits`` (column ``limit``), also for limits that no document
    has as its length. Each takes the sums of the longest length up to it; below all lengths every document is cut. Null
    limits have no row, repeated ones a row each, other columns are ignored; of an empty histogram all sums are 0.

    Limits beyond the longest length, or below 0, are looked up as that length, or as -1. What is looked up is then
    distinct, at most ``BLOCK`` values in each block of lengths, and only blocks are ordered in one place.
    """
    whole = histogram.agg(
        F.coalesce(F.max("length"), F.lit(-1)).alias("longest"),
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"),
        F.coalesce(F.sum(F.col("length") * F.col("n_docs")), F.lit(0)).alias("tokens"),
    )
    longest, docs, tokens = (whole.select(c).scalar() for c in ("longest", "docs", "tokens"))
    at = F.greatest(F.least(F.col("limit"), longest), F.lit(-1)).cast("bigint")
    asked = limits.where("limit IS NOT NULL").select("limit", at.alias("at"))
    known = limit_table(histogram).select(F.col("length").alias("at"), F.struct("docs_longer", "tokens_longer").alias("beyond"))
    empty = F.lit(None).cast(known.schema["beyond"].dataType).alias("beyond")
    points = known.unionByName(asked.select("at", empty)).groupBy("at").agg(F.max("beyond").alias("beyond"))
    points = points.withColumn("block", F.floor(F.col("at") / BLOCK))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = points.groupBy("block").agg(F.max_by("beyond", F.when(F.col("beyond").isNotNull(), F.col("at"))).alias("last"))
    carried = last.select("block", F.last("last", ignorenulls=True).over(before).alias("carried"))
    upward = Window.partitionBy("block").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = points.withColumn("inside", F.last("beyond", ignorenulls=True).over(upward)).join(carried, "block")
    sums = placed.select("at", F.coalesce("inside", "carried").alias("sums"))
    cut = F.coalesce("sums.docs_longer", docs)
    kept = tokens - F.coalesce("sums.tokens_longer", tokens) + F.col("limit") * cut
    return asked.join(sums, "at").select("limit", kept.alias("truncated_total"), cut.alias("docs_cut"))


def quantile_length(histogram: DataFrame, share: float) -> int | None:
    """The smallest length within which at least ``share`` of the documents lie; null for an empty histogram."""
    return limit_table(histogram).where(F.col("quantile") >= F.lit(share)).agg(F.min("length")).first()[0]
