"""Faulty panels and landings, for the failing side of every check."""

from __future__ import annotations

import uuid
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.plans.refresh import ChecksFailed, refresh
from barloom.queries.landed import INGESTED_AT, Published, land, summary_documents
from barloom.queries.layers import Layers, WIDE, raw_text_bars, series_bars, series_universe
from barloom.session import shared_folder, stored
from barloom.settings import LAYERS, SOURCE_COLUMNS, Settings
from barloom.sources.bars import supplier_panel

FAULTY_LANDING, WIDE_RUN = "run-x", "run-w"
PRICES = ["open", "high", "low", "close", "adjclose", "volume"]
#: Folders whose names a path must encode.
FOLDERS = {"AF": "A F+1", "NO": "N%O"}


def _workspace(spark: SparkSession, bars: DataFrame, universe: DataFrame, daily_glob: str, **more) -> Published:
    root, tag = shared_folder(spark), uuid.uuid4().hex[:8]
    universe.write.parquet(f"{root}/universe")
    settings = Settings(
        warehouse=f"{root}/warehouse",
        landing_path=f"{root}/landing",
        universe=f"{root}/universe",
        schemas={layer: f"{layer}_{tag}" for layer in LAYERS},
        daily_glob=daily_glob,
        summary_glob="summaries/*/*.json",
        **more,
    )
    return Published(settings, bars)


@lru_cache(maxsize=4)
def _faulty_landing(spark: SparkSession, application: str, sf_dir: str) -> Published:
    """The six series, landed with one fault each: AF declares five rows too many, AO another symbol, NF another
    source run; NO has two names of its header swapped, RF a field too many in its first line, RO no run summary."""
    bars = stored(series_bars(spark, sf_dir))

    def folder(entity: str) -> Column:
        named = F.col(entity)
        for ticker, name in FOLDERS.items():
            named = F.when(F.col(entity) == ticker, F.lit(name)).otherwise(named)
        return named

    # What the store makes of a name with a percent sign.
    names = F.concat(F.lit("folder="), F.replace(folder("ticker"), F.lit("%"), F.lit("%25")))
    work = _workspace(spark, bars, series_universe(bars).withColumn("folder", names), "daily/*/*.txt")
    first = F.row_number().over(Window.partitionBy("ticker").orderBy("trade_date")) == 1
    line = F.concat_ws(",", F.date_format("trade_date", "yyyy-MM-dd"), *[F.col(c).cast("string") for c in PRICES], F.lit(INGESTED_AT))
    line = F.when((F.col("ticker") == "RF") & first, F.concat(line, F.lit(",extra"))).otherwise(line)
    rows = bars.select("ticker", F.col("trade_date").alias("place"), line.alias("line"))
    swapped = [*SOURCE_COLUMNS[:1], SOURCE_COLUMNS[2], SOURCE_COLUMNS[1], *SOURCE_COLUMNS[3:]]
    header = F.when(F.col("ticker") == "NO", ",".join(swapped)).otherwise(",".join(SOURCE_COLUMNS))
    heads = bars.select("ticker").distinct().select("ticker", F.lit(None).cast("date").alias("place"), header.alias("line"))
    (
        rows.unionByName(heads)
        .select(folder("ticker").alias("folder"), "place", "line")
        .repartition("folder")
        .sortWithinPartitions("folder", F.col("place").asc_nulls_first())
        .select("folder", "line")
        .write.partitionBy("folder")
        .text(f"{work.settings.landing_path}/daily")
    )
    documents = summary_documents(
        bars.where("ticker != 'RO'"),
        extra_rows=F.when(F.col("ticker") == "AF", 5).otherwise(0),
        symbol=F.when(F.col("ticker") == "AO", "AO.Y").otherwise(F.concat("ticker", F.lit(".X"))),
        run_id=F.when(F.col("ticker") == "NF", "source-2").otherwise("source-1"),
    )
    documents = documents.withColumn("folder", folder("entity")).drop("entity")
    documents.write.partitionBy("folder").json(f"{work.settings.landing_path}/summaries")
    try:
        refresh(spark, work.settings, FAULTY_LANDING, FAULTY_LANDING)
    except ChecksFailed:
        return work
    raise AssertionError("the planted faults were not caught")


@lru_cache(maxsize=4)
def _wide(spark: SparkSession, application: str, sf_dir: str) -> Published:
    """One series per supplier, landed and refreshed: on no date do all of them trade."""
    bars = stored(supplier_panel(spark, sf_dir))
    work = _workspace(spark, bars, series_universe(bars), "daily/*/*.csv", panel=WIDE)
    land(bars, work.settings.landing_path)
    refresh(spark, work.settings, WIDE_RUN, WIDE_RUN)
    return work


def faulty_landing(spark: SparkSession, sf_dir: str) -> Published:
    return _faulty_landing(spark, spark.sparkContext.applicationId, sf_dir)


def wide(spark: SparkSession, sf_dir: str) -> Published:
    return _wide(spark, spark.sparkContext.applicationId, sf_dir)


def judged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as text bars of one series per user; a user may have several in a day."""
    users = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.col("user_id").cast("string").alias("user"))
    return raw_text_bars(spark, sf_dir).join(users, "event_id").withColumn("ticker", F.col("user")).drop("user")


def faulty_gold(layers: Layers) -> tuple[dict[str, DataFrame], DataFrame]:
    """(measure tables, silver) of the series with a fault for every check of the measures: NO has its bar of the base
    date twice, AF its last ten days missing, RF a positive drawdown and RO another index on the base date, AO is
    missing in the summary and ZZ is too many, NF has another total return and another source run, the months of RF do
    not compound."""
    tables, silver = dict(layers.gold()), layers.silver
    name, daily, summary = F.col("ticker"), tables["fact_daily_metrics"], tables["ticker_summary"]
    on_base = F.col("trade_date") == layers.base
    last = silver.agg(F.max("trade_date")).scalar()
    bars = daily.where(~((name == "AF") & (F.col("trade_date") > F.date_sub(last, 10))))
    bars = bars.unionByName(bars.where((name == "NO") & on_base))
    tables["fact_daily_metrics"] = stored(
        bars.withColumn("drawdown", F.when((name == "RF") & on_base, 0.5).otherwise(F.col("drawdown"))).withColumn(
            "normalized_index", F.when((name == "RO") & on_base, 101.0).otherwise(F.col("normalized_index"))
        )
    )
    extra = summary.where(name == "AF").withColumn("ticker", F.lit("ZZ"))
    moved = F.when(name == "NF", F.col("total_return") + 0.01).otherwise(F.col("total_return"))
    tables["ticker_summary"] = summary.where(name != "AO").unionByName(extra).withColumn("total_return", moved)
    months = tables["fact_monthly_metrics"]
    tables["fact_monthly_metrics"] = months.withColumn(
        "monthly_return", F.when(name == "RF", F.col("monthly_return") + 0.01).otherwise(F.col("monthly_return"))
    )
    return tables, silver.withColumn("source_run_id", F.when(name == "NF", "S2").otherwise("S1"))
