"""Adapters that turn transaction tables into panels of daily bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LINEITEM_COLUMNS = (
    "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate",
)


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*LINEITEM_COLUMNS)


def daily_bars(items: DataFrame, entity: Column) -> DataFrame:
    """One bar per entity and shipping date.

    Amounts are summed as whole cents, so the result does not depend on the order of the rows. The grouping combines
    before its shuffle, so an entity that holds most of the items still sends one partial row per date and task.
    """
    price = F.col("l_extendedprice")
    n = F.count("*").cast("double")

    def mean_of_cents(amount: Column) -> Column:
        return F.sum(F.floor(amount * 100).cast("bigint")) / n / 100

    return (
        items.groupBy(entity.alias("ticker"), F.col("l_shipdate").cast("date").alias("trade_date"))
        .agg(
            F.min(price).alias("low"),
            F.max(price).alias("high"),
            mean_of_cents(price).alias("mean_price"),
            mean_of_cents(price * (1 - F.col("l_discount"))).alias("adjclose"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
        )
        .select(
            "ticker",
            "trade_date",
            ((F.col("low") + F.col("high")) / 2).alias("open"),
            "high",
            "low",
            # flooring can push the mean a cent below the low
            F.greatest("mean_price", "low").alias("close"),
            "adjclose",
            "volume",
        )
    )


def fill_gaps(bars: DataFrame) -> DataFrame:
    """Give every entity a bar on every date of the panel from its own first date on.

    A missing date repeats the last close at volume 0. The panel's dates are numbered, a list that the calendar
    bounds; each bar spreads over the numbers up to the entity's next bar, so exactly the rows of the result are made
    and a stray date far away costs nothing.
    """
    dates = bars.select("trade_date").distinct()
    numbered = dates.select("trade_date", F.row_number().over(Window.orderBy("trade_date")).alias("n"))
    last = dates.agg(F.count("*")).scalar().cast("int")
    series = Window.partitionBy("ticker").orderBy("trade_date")
    until = F.coalesce(F.lead("n").over(series) - 1, last)
    own = F.col("trade_date") == F.col("bar_date")

    def filled(column: str) -> Column:
        return F.when(own, F.col(column)).otherwise(F.col("close")).alias(column)

    return (
        bars.join(numbered, "trade_date")
        .withColumn("until", until)
        .withColumn("n", F.explode(F.sequence("n", "until")))
        .withColumnRenamed("trade_date", "bar_date")
        .join(numbered, "n")
        .select(
            "ticker",
            "trade_date",
            filled("open"),
            filled("high"),
            filled("low"),
            "close",
            "adjclose",
            F.when(own, F.col("volume")).otherwise(F.lit(0).cast("bigint")).alias("volume"),
        )
    )


def series_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six long series (one per return flag and line status), gaps filled."""
    return fill_gaps(daily_bars(lineitem(spark, sf_dir), F.concat("l_returnflag", "l_linestatus")))


def supplier_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sparse series per supplier: a panel that widens with the data."""
    return daily_bars(lineitem(spark, sf_dir), F.col("l_suppkey").cast("string"))
