"""The layers of a panel built straight from the given tables, without landing files."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.daily import daily_metrics
from barloom.operators.flags import base_date, untraded_dates, volume_status
from barloom.operators.lineage import dimension
from barloom.operators.periods import monthly_metrics, yearly_metrics
from barloom.operators.summary import summary_metrics
from barloom.session import stored
from barloom.sources.bars import daily_bars, fill_gaps, lineitem, supplier_panel
from barloom.spec import PanelSpec

# Share of the suppliers that must trade on the base date; on no date do all of them.
WIDE = PanelSpec(min_coverage=0.15)


class Layers:
    """Silver bars, base date and measures of one panel."""

    def __init__(self, bars: DataFrame, spec: PanelSpec = PanelSpec(), bars_stored: bool = False):
        """``bars_stored`` says that the bars are files already: only the untraded dates are written besides, and each
        use of the silver bars reads the files and takes the dates to them."""
        self.spec = spec
        if bars_stored:
            self.silver = volume_status(bars, spec, stored(untraded_dates(bars, spec)))
        else:
            self.silver = stored(volume_status(bars, spec))

    @cached_property
    def base(self) -> Column:
        n_entities = self.silver.select("ticker").distinct().agg(F.count("*")).scalar()
        return base_date(self.silver, n_entities, self.spec).scalar()

    @cached_property
    def last_date(self) -> Column:
        return self.silver.agg(F.max("trade_date")).scalar()

    @cached_property
    def daily(self) -> DataFrame:
        return daily_metrics(self.silver, self.base, self.spec)

    @cached_property
    def fact(self) -> DataFrame:
        """The daily measures as a stored table, for queries that use them more than once."""
        return stored(self.daily)

    def monthly(self, daily: DataFrame) -> DataFrame:
        return monthly_metrics(daily, self.base, self.spec, self.last_date)

    def yearly(self, daily: DataFrame) -> DataFrame:
        return yearly_metrics(daily, self.base, self.spec, self.last_date)

    def summary(self, daily: DataFrame) -> DataFrame:
        return summary_metrics(daily, self.base, self.spec)

    def dim(self) -> DataFrame:
        return dimension(series_universe(self.silver))

    def gold(self) -> dict[str, DataFrame]:
        """All five measure tables, stored."""
        return {
            "dim_ticker": stored(self.dim()),
            "fact_daily_metrics": self.fact,
            "fact_monthly_metrics": stored(self.monthly(self.fact)),
            "fact_yearly_metrics": stored(self.yearly(self.fact)),
            "ticker_summary": stored(self.summary(self.fact)),
        }


def series_bars(spark: SparkSession, sf_dir: str, entity: Column | None = None) -> DataFrame:
    """Gap-filled bars of the long series, from one pass over the line items."""
    entity = F.concat("l_returnflag", "l_linestatus") if entity is None else entity
    return fill_gaps(stored(daily_bars(lineitem(spark, sf_dir), entity)))


def series_layers(spark: SparkSession, sf_dir: str, entity: Column | None = None) -> Layers:
    return Layers(series_bars(spark, sf_dir, entity))


def supplier_layers(spark: SparkSession, sf_dir: str) -> Layers:
    return Layers(stored(supplier_panel(spark, sf_dir)), WIDE, bars_stored=True)


def series_universe(silver: DataFrame) -> DataFrame:
    """A universe for the entities of a panel, in the columns a configured one has."""
    ticker = F.col("ticker")
    return silver.select(ticker).distinct().select(
        ticker,
        F.concat(ticker, F.lit(".X")).alias("source_symbol"),
        F.concat(F.lit("folder="), ticker).alias("folder"),
        F.concat(F.lit("Series "), ticker).alias("bank_name"),
        F.lower(ticker).alias("short_name"),
    )


def raw_text_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events rendered as landed text bars, with faults of every kind planted by event id."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "ts", "event_type", "props")
    level = F.col("event_id") % 500

    def every(n: int) -> Column:
        return F.col("event_id") % n == 0

    def text(value: Column) -> Column:
        return value.cast("string")

    return events.select(
        "event_id",
        F.col("event_type").alias("ticker"),
        F.when(every(17), "2024-13-45").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("source_date"),
        F.when(every(13), "abc").when(every(11), "0").otherwise(text(level + 10)).alias("open"),
        text(level + 12).alias("high"),
        F.when(every(19), text(level + 11)).otherwise(text(level + 9)).alias("low"),
        text(level + 11).alias("close"),
        F.when(every(23), "-1.5").otherwise(F.concat(text(level + 10), F.lit(".5"))).alias("adjclose"),
        F.when(every(7), "-5").when(every(29), "n/a").otherwise(text(F.col("user_id") % 1000)).alias("volume"),
        F.when(every(37), "not a time").otherwise("2026-10-09 05:43:40.875883+00:00").alias("ingested_at_utc"),
        F.when(every(31), F.col("props")).alias("_rescued_data"),
    )
