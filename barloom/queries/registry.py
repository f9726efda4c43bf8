"""Registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators import layer_checks
from barloom.operators.daily import DAILY_COLUMNS, daily_metrics
from barloom.operators.diff import snapshot_diff, unmatched_keys, verdict
from barloom.operators.flags import adjclose_not_carried, entity_profile, untraded_dates, zero_volume_not_flat
from barloom.operators.flags import volume_status as volume_status_of
from barloom.operators.inject import replace_row_with_previous
from barloom.operators.series import SeriesSplit
from barloom.operators.validate import duplicate_keys, reason_histogram, reject_reasons, split_rows, type_bars
from barloom.plans import reconcile, serving
from barloom.plans.compare import COMPARED
from barloom.plans.compare import rerun_report as compare_runs
from barloom.plans.refresh import GOLD_KEYS
from barloom.queries.layers import (
    raw_text_bars,
    series_bars,
    series_layers,
    series_universe,
    supplier_layers,
)
from barloom.session import stored
from barloom.queries.faults import FAULTY_LANDING, WIDE_RUN, faulty_gold, faulty_landing, judged_events, wide
from barloom.queries.landed import FAULTY_RUN, GOOD_RUN, RECOVERY_RUN, published, recovered
from barloom.sources import landing
from barloom.sources.bars import daily_bars, lineitem, supplier_panel
from barloom.sources.catalog import column_metadata, table_metadata
from barloom.spec import PanelSpec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# What the parameterised queries are asked for.
CHOSEN = ["AF", "RF"]
CHOSEN_YEAR = 1996
CHOSEN_MONTH = datetime.date(1996, 3, 1)
FAULT_ROW = 100
SMALL_SPLIT = SeriesSplit(block_days=100, chunk_rows=90)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(frame: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Fix the digits of doubles whose last bits depend on summation order."""
    return frame.withColumns({c: F.round(c, digits) for c in columns})


# ---------------------------------------------------------------- panel and flags


@query
def bars(spark, sf_dir):
    return daily_bars(lineitem(spark, sf_dir), F.concat("l_returnflag", "l_linestatus"))


@query
def supplier_bars(spark, sf_dir):
    return supplier_panel(spark, sf_dir)


@query
def filled_bars(spark, sf_dir):
    return series_bars(spark, sf_dir)


@query
def volume_status(spark, sf_dir):
    return series_layers(spark, sf_dir).silver.select("ticker", "trade_date", "volume", "volume_status")


@query
def status_counts(spark, sf_dir):
    return reconcile.status_counts(series_layers(spark, sf_dir).silver)


@query
def zero_partial_rows(spark, sf_dir):
    return reconcile.zero_partial_rows(series_layers(spark, sf_dir).silver)


@query
def base_date(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    return layers.silver.agg(F.max("trade_date").alias("last_date")).select(layers.base.alias("base_date"), "last_date")


@query
def untraded_calendar_dates(spark, sf_dir):
    """Dates on which no item was returned, taking the quantity of returned items as the volume."""
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0)
    items = lineitem(spark, sf_dir).withColumn("l_quantity", returned)
    return untraded_dates(daily_bars(items, F.col("l_suppkey").cast("string"))).select("trade_date")


@query
def flat_check(spark, sf_dir):
    """Supplier bars with small volumes taken as zero: rows that are not flat or do not repeat the previous close."""
    return zero_volume_not_flat(_thin_supplier_bars(spark, sf_dir)).select("ticker", "trade_date", "close", "prev_close")


@query
def flat_check_split(spark, sf_dir):
    broken = zero_volume_not_flat(_thin_supplier_bars(spark, sf_dir), PanelSpec(), SMALL_SPLIT)
    return broken.select("ticker", "trade_date", "close", "prev_close")


@query
def zero_volume_profile(spark, sf_dir):
    """Per supplier: dates, duplicated keys, and zero-volume rows that are not flat or not carried."""
    return entity_profile(_thin_supplier_bars(spark, sf_dir))


@query
def carry_check(spark, sf_dir):
    return adjclose_not_carried(_thin_supplier_bars(spark, sf_dir)).select(
        "ticker", "trade_date", "adjclose", "prev_adjclose"
    )


def _thin_supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    thin = F.when(F.col("volume") <= 5, F.lit(0).cast("bigint")).otherwise(F.col("volume"))
    return stored(supplier_panel(spark, sf_dir).withColumn("volume", thin))


@query
def same_date_set(spark, sf_dir):
    silver = supplier_layers(spark, sf_dir).silver
    gaps = layer_checks.date_set_gaps(silver, entity_profile(silver), series_universe(silver), PanelSpec())
    return gaps.select("ticker", "n_dates", "n_union")


# ---------------------------------------------------------------- measures


def _daily_columns(daily: DataFrame) -> DataFrame:
    return rounded(
        daily.select("ticker", "trade_date", *DAILY_COLUMNS), "normalized_index", "daily_return", "vol_60d_ann", "drawdown", "rel_volume_60d"
    )


@query
def daily_kpis(spark, sf_dir):
    return _daily_columns(series_layers(spark, sf_dir).daily)


@query
def daily_kpis_split(spark, sf_dir):
    """The same measures with every series cut into small blocks and chunks, as a panel with hot series needs."""
    layers = series_layers(spark, sf_dir)
    return _daily_columns(daily_metrics(layers.silver, layers.base, layers.spec, SMALL_SPLIT))


@query
def supplier_daily_kpis(spark, sf_dir):
    return _daily_columns(supplier_layers(spark, sf_dir).daily)


@query
def normalized_index(spark, sf_dir):
    daily = series_layers(spark, sf_dir).daily
    return rounded(daily.select("ticker", "trade_date", "normalized_index"), "normalized_index")


@query
def daily_return(spark, sf_dir):
    daily = series_layers(spark, sf_dir).daily
    return rounded(daily.select("ticker", "trade_date", "volume_status", "daily_return"), "daily_return")


@query
def rolling_vol(spark, sf_dir):
    daily = series_layers(spark, sf_dir).daily
    return rounded(daily.select("ticker", "trade_date", "vol_60d_ann"), "vol_60d_ann")


@query
def relative_volume(spark, sf_dir):
    daily = series_layers(spark, sf_dir).daily
    return rounded(daily.select("ticker", "trade_date", "rel_volume_60d"), "rel_volume_60d")


@query
def drawdown(spark, sf_dir):
    daily = series_layers(spark, sf_dir).daily
    columns = ["ticker", "trade_date", "running_peak", "running_peak_date", "drawdown"]
    return rounded(daily.select(*columns), "drawdown")


def _summary_columns(summary: DataFrame) -> DataFrame:
    return rounded(summary, "total_return", "vol_full_ann", "max_drawdown", "current_drawdown")


@query
def summary(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    return _summary_columns(layers.summary(layers.daily))


@query
def supplier_summary(spark, sf_dir):
    layers = supplier_layers(spark, sf_dir)
    return _summary_columns(layers.summary(layers.daily))


@query
def monthly(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    return rounded(layers.monthly(layers.daily), "monthly_return", "avg_daily_volume")


@query
def supplier_monthly(spark, sf_dir):
    layers = supplier_layers(spark, sf_dir)
    return rounded(layers.monthly(layers.daily), "monthly_return", "avg_daily_volume")


@query
def yearly(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    return rounded(layers.yearly(layers.daily), "yearly_return")


@query
def dimension(spark, sf_dir):
    return series_layers(spark, sf_dir).dim()


# ---------------------------------------------------------------- validation


@query
def typed_bars(spark, sf_dir):
    typed = type_bars(raw_text_bars(spark, sf_dir))
    return typed.select("event_id", "typed.trade_date", "typed.open", "typed.low", "typed.adjclose", "typed.volume")


@query
def reject_reasons_of_rows(spark, sf_dir):
    flagged = reject_reasons(type_bars(raw_text_bars(spark, sf_dir)))
    return flagged.select("event_id", F.size("reject_reasons").alias("n_codes"), "reject_reason")


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return split_rows(reject_reasons(type_bars(raw_text_bars(spark, sf_dir))))


@query
def quarantine_split(spark, sf_dir):
    valid, rejected = _split(spark, sf_dir)
    parts = valid.select(F.lit("valid").alias("outcome"), "ticker").unionByName(
        rejected.select(F.lit("rejected").alias("outcome"), "ticker")
    )
    return parts.groupBy("outcome", "ticker").agg(F.count("*").alias("n_rows"))


@query
def quarantined_rows(spark, sf_dir):
    return _split(spark, sf_dir)[1].select(
        "event_id", "ticker", "source_date", "open", "high", "low", "close", "adjclose", "volume", "reject_reason"
    )


@query
def reason_histogram_of_rows(spark, sf_dir):
    return reason_histogram(_split(spark, sf_dir)[1])


@query
def quarantine_reasons(spark, sf_dir):
    return reconcile.quarantine_reasons(_split(spark, sf_dir)[1])


@query
def duplicate_order_lines(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return duplicate_keys(items, "l_orderkey", "l_linenumber").withColumnRenamed("count", "copies")


@query
def order_line_keys(spark, sf_dir):
    return reconcile.key_counts(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_orderkey", "l_linenumber"])


@query
def json_projection(spark, sf_dir):
    """One field of a JSON text, and the whole document."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "props")
    parsed = events.withColumn("doc", F.from_json("props", "k BIGINT"))
    whole = F.to_json(F.try_parse_json("props"))
    return parsed.select("event_id", F.col("doc.k").alias("k"), whole.alias("raw_json"))


# ---------------------------------------------------------------- serving


@query
def summary_dataset(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    summary = layers.summary(layers.daily).withColumns(
        {"source_run_id": F.lit("S1"), "source_ingested_at": F.lit(None).cast("timestamp")}
    )
    return _summary_columns(serving.summary_dataset(summary, layers.dim())).drop("source_ingested_at")


@query
def daily_dataset(spark, sf_dir):
    out = serving.daily_dataset(series_layers(spark, sf_dir).daily)
    return rounded(out, "normalized_index", "daily_return", "vol_60d_ann", "drawdown", "rel_volume_60d")


@query
def monthly_dataset(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    return rounded(serving.monthly_dataset(layers.monthly(layers.daily)), "monthly_return", "avg_daily_volume")


@query
def yearly_dataset(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    return rounded(serving.yearly_dataset(layers.yearly(layers.daily)), "yearly_return")


@query
def return_ranking(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    return rounded(serving.ranking(layers.summary(layers.daily), "total_return"), "total_return")


@query
def volatility_ranking(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    return rounded(serving.ranking(layers.summary(layers.daily), "vol_full_ann"), "vol_full_ann")


@query
def monthly_pivot(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    entities = [a + b for a in "ANR" for b in "FO"]
    return rounded(serving.monthly_matrix(layers.monthly(layers.daily), entities), *entities)


@query
def filtered_daily(spark, sf_dir):
    chosen = serving.for_entities(serving.daily_dataset(series_layers(spark, sf_dir).daily), CHOSEN)
    ranged = serving.in_range(chosen, datetime.date(1996, 1, 1), datetime.date(1996, 12, 31))
    return rounded(ranged, "normalized_index", "daily_return", "vol_60d_ann", "drawdown", "rel_volume_60d")


@query
def filtered_monthly(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    chosen = serving.for_entities(serving.monthly_dataset(layers.monthly(layers.daily)), CHOSEN)
    ranged = serving.in_range(chosen, datetime.date(1996, 1, 1), datetime.date(1997, 6, 30))
    return rounded(ranged, "monthly_return", "avg_daily_volume")


# ---------------------------------------------------------------- validation of the measure tables


@query
def table_counts(spark, sf_dir):
    return reconcile.table_counts(series_layers(spark, sf_dir).gold())


@query
def table_key_counts(spark, sf_dir):
    return reconcile.table_key_counts(series_layers(spark, sf_dir).gold(), GOLD_KEYS)


@query
def partial_periods(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    return reconcile.partial_period_counts(layers.monthly(layers.fact), layers.yearly(layers.fact))


@query
def leading_nulls(spark, sf_dir):
    layers = supplier_layers(spark, sf_dir)
    return reconcile.leading_null_rows(layers.fact)


@query
def null_vol_after_warmup(spark, sf_dir):
    return reconcile.null_vol_after_warmup(series_layers(spark, sf_dir).fact)


@query
def peak_and_trough_rows(spark, sf_dir):
    # Not from the stored measures: each use takes the few it reads, already by entity, and no rolling ones.
    layers = supplier_layers(spark, sf_dir)
    return reconcile.peak_and_trough_rows(layers.summary(layers.daily), layers.daily)


@query
def compounding_check(spark, sf_dir):
    layers = supplier_layers(spark, sf_dir)
    products = layer_checks.year_products(layers.monthly(layers.daily))
    return rounded(
        layers.yearly(layers.daily).join(products, ["ticker", "year"]).select(
            "ticker", "year", (1 + F.col("yearly_return")).alias("yearly_growth"), "compound"
        ),
        "yearly_growth", "compound",
    )


def _checked(frame: DataFrame, measure: str) -> DataFrame:
    return rounded(_agreeing(frame), f"silver_{measure}", f"gold_{measure}")


def _agreeing(frame: DataFrame) -> DataFrame:
    """Whether the two values are the same, before any rounding."""
    return frame.select(*[c for c in frame.columns if c != "abs_diff"], (F.col("abs_diff") <= 1e-9).alias("agrees"))


@query
def total_return_reconciliation(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    return _checked(reconcile.total_return_check(layers.silver, layers.summary(layers.daily)), "total_return")


@query
def drawdown_reconciliation(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    return _checked(reconcile.max_drawdown_check(layers.silver, layers.summary(layers.daily)), "max_drawdown")


@query
def vol_reconciliation(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    return _checked(reconcile.volatility_check(layers.silver, layers.summary(layers.daily)), "vol_full_ann")


@query
def yearly_return_reconciliation(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    checked = reconcile.yearly_return_check(layers.silver, layers.yearly(layers.fact), CHOSEN[0], CHOSEN_YEAR)
    return _checked(checked, "yearly_return")


@query
def monthly_return_reconciliation(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    checked = reconcile.monthly_return_check(layers.silver, layers.monthly(layers.fact), CHOSEN[1], CHOSEN_MONTH)
    return _checked(checked, "monthly_return")


# ---------------------------------------------------------------- snapshots and faults


def diff_cases(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Supplier bars, and what they are compared with: themselves and six changed copies."""
    panel = stored(supplier_panel(spark, sf_dir)).withColumn("status", F.lit("normal"))
    first = panel.filter(F.col("ticker") == "1").agg(F.min("trade_date")).scalar()
    one_row = (F.col("ticker") == "1") & (F.col("trade_date") == first)

    def with_one(column: str, value: Column) -> DataFrame:
        return panel.withColumn(column, F.when(one_row, value).otherwise(F.col(column)))

    cases = {
        "same": panel,
        "row removed": panel.filter(~one_row),
        "double within tolerance": with_one("adjclose", F.col("adjclose") + 5e-10),
        "double moved": with_one("adjclose", F.col("adjclose") + 0.5),
        "text changed": with_one("status", F.lit("zero_partial")),
        "value lost": with_one("adjclose", F.lit(None).cast("double")),
        "row doubled": panel.unionByName(panel.filter(one_row)),
    }
    return panel, cases


@query
def snapshot_diff_cases(spark, sf_dir):
    """Supplier bars against themselves and against six changed copies."""
    panel, cases = diff_cases(spark, sf_dir)
    out = None
    for label, changed in cases.items():
        row = snapshot_diff(panel, changed, ["ticker", "trade_date"]).select(
            F.lit(label).alias("case_name"), "rows_prev", "rows_latest", "dup_keys", "missing_rows",
            "mismatched_non_double",
            F.when(F.col("max_double_diff") > 1e300, -1.0).otherwise(F.round("max_double_diff", 6)).alias("max_diff"),
            verdict().alias("result"),
        )
        out = row if out is None else out.unionByName(row)
    return out


@query
def snapshot_diff_restated(spark, sf_dir):
    """Supplier bars against a restatement: later prices moved, large volumes counted one up, the last date not in yet."""
    before = stored(supplier_panel(spark, sf_dir))
    later = F.col("trade_date") >= F.lit(datetime.date(1998, 1, 1))
    after = (
        before.filter(F.col("trade_date") < before.agg(F.max("trade_date")).scalar())
        .withColumn("adjclose", F.when(later, F.col("adjclose") + 0.25).otherwise(F.col("adjclose")))
        .withColumn("volume", F.when(F.col("volume") > 45, F.col("volume") + 1).otherwise(F.col("volume")))
    )
    diff = snapshot_diff(before, after, ["ticker", "trade_date"]).withColumn("result", verdict())
    return rounded(diff.drop("note"), "max_double_diff")


@query
def snapshot_row_counts(spark, sf_dir):
    """Counts-only comparison: accepted events against all events."""
    raw = raw_text_bars(spark, sf_dir)
    diff = snapshot_diff(raw, _split(spark, sf_dir)[0].select(*raw.columns), None)
    return diff.select("rows_prev", "rows_latest", verdict().alias("result"))


@query
def unmatched_customers(spark, sf_dir):
    """Customers without an event, and users with events who are no customer."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("custkey"))
    users = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("custkey"))
    return unmatched_keys(customers, users, ["custkey"])


@query
def fault_injection(spark, sf_dir):
    panel = stored(series_bars(spark, sf_dir))
    edited = replace_row_with_previous(panel, "ticker", "trade_date", CHOSEN[1], FAULT_ROW)
    return edited.select("ticker", "trade_date", "close", "adjclose", "volume")


@query
def duplicate_after_fault(spark, sf_dir):
    panel = stored(series_bars(spark, sf_dir))
    edited = replace_row_with_previous(panel, "ticker", "trade_date", CHOSEN[1], FAULT_ROW)
    return duplicate_keys(edited, "ticker", "trade_date").withColumnRenamed("count", "copies")


# ---------------------------------------------------------------- checks

RESULT = ["check_name", "layer", "severity", "passed", "failing_count", "details"]
FAILURE = ["check_name", "entity", "trade_date", "value"]


def _failing_items(results: DataFrame, failures: dict[str, DataFrame]) -> DataFrame:
    """All failing items of the checks that counted some."""
    counted = results.where("failing_count != 0").select("check_name")
    return reduce(DataFrame.unionByName, failures.values()).join(counted, "check_name", "left_semi").select(*FAILURE)


def _series_silver(spark, sf_dir):
    silver = stored(series_layers(spark, sf_dir).silver.withColumn("source_ingested_at", F.lit(datetime.datetime(2026, 1, 1))))
    return silver, _split(spark, sf_dir)[1], stored(entity_profile(silver)), series_universe(silver)


@query
def silver_check_results(spark, sf_dir):
    layer = _series_silver(spark, sf_dir)
    n_bronze = layer[0].agg(F.count("*")).scalar() + raw_text_bars(spark, sf_dir).agg(F.count("*")).scalar()
    return layer_checks.silver_checks(*layer, 6, n_bronze).select(*RESULT)


def _faulty_silver(spark, sf_dir):
    """All events that have a date as a panel, the rejected ones too, as if they had been let in, and a user without any:
    repeated keys, missing, negative and inconsistent values, and more rows than were landed."""
    judged = stored(reject_reasons(type_bars(judged_events(spark, sf_dir))))
    rejected = split_rows(judged)[1]
    bars = judged.select("ticker", "typed.*").where("trade_date IS NOT NULL")
    silver = stored(volume_status_of(bars))
    universe = series_universe(silver).unionByName(series_universe(silver.limit(1).withColumn("ticker", F.lit("ghost"))))
    return judged, (silver, rejected, stored(entity_profile(silver)), universe)


@query
def faulty_silver_check_results(spark, sf_dir):
    judged, layer = _faulty_silver(spark, sf_dir)
    checks = layer_checks.silver_checks(*layer, layer[3].count(), judged.agg(F.count("*")).scalar())
    return checks.select(*RESULT)


@query
def faulty_silver_failures(spark, sf_dir):
    """Every row or entity that fails a check of the faulty panel; the prices of a row are left out."""
    judged, layer = _faulty_silver(spark, sf_dir)
    results = layer_checks.silver_checks(*layer, layer[3].count(), judged.agg(F.count("*")).scalar())
    items = _failing_items(results, layer_checks.silver_failures(*layer))
    return items.withColumn("value", F.when(F.col("value").startswith("open="), F.lit("row")).otherwise(F.col("value")))


@query
def gold_check_results(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    silver = layers.silver.withColumns(
        {"source_run_id": F.lit("S1"), "source_ingested_at": F.lit(datetime.datetime(2026, 1, 1))}
    )
    return _gold_results(layers, layers.gold(), silver)[0]


def _gold_results(layers, tables, silver):
    silver = silver.withColumn("source_ingested_at", F.lit(datetime.datetime(2026, 1, 1)))
    profile = stored(layer_checks.daily_profile(tables["fact_daily_metrics"], layers.base))
    universe = series_universe(silver)
    results = layer_checks.gold_checks(tables, silver, universe, layers.base, GOLD_KEYS, profile)
    return results.select(*RESULT), layer_checks.gold_failures(tables, silver, universe, GOLD_KEYS, profile)


@query
def faulty_gold_check_results(spark, sf_dir):
    layers = series_layers(spark, sf_dir)
    return _gold_results(layers, *faulty_gold(layers))[0]


@query
def faulty_gold_failures(spark, sf_dir):
    """Every item that fails a check of the faulty measures; where its value is a double, it is left out."""
    layers = series_layers(spark, sf_dir)
    items = _failing_items(*_gold_results(layers, *faulty_gold(layers)))
    return items.withColumn("value", F.when(F.col("value").rlike("[0-9][.][0-9]"), F.lit("double")).otherwise(F.col("value")))


# ---------------------------------------------------------------- a landing with faults, a wide panel


@query
def faulty_landing_check_results(spark, sf_dir):
    results = faulty_landing(spark, sf_dir).table("ops", "dq_results")
    return results.where(F.col("pipeline_run_id") == FAULTY_LANDING).select(*RESULT)


@query
def faulty_landing_failures(spark, sf_dir):
    """All failing items of the landing; of a header its text."""
    found = faulty_landing(spark, sf_dir).table("ops", "check_failures").where(F.col("pipeline_run_id") == FAULTY_LANDING)
    value = F.regexp_replace("value", "^.*( header=)", "$1")
    return found.select("check_name", "entity", "trade_date", F.ltrim(value).alias("value"))


@query
def faulty_landing_report(spark, sf_dir):
    return landing.landing_report(spark, faulty_landing(spark, sf_dir).settings)


@query
def rescued_lines(spark, sf_dir):
    """Landed rows of the entity whose first line has a field too many."""
    raw = landing.read_daily(spark, faulty_landing(spark, sf_dir).settings, FAULTY_LANDING, datetime.datetime(2026, 1, 1))
    rows = raw.where("ticker = 'RF'")
    beyond = F.from_json("_rescued_data", "map<string, string>")
    return rows.select("ticker", "source_date", F.try_element_at(beyond, F.lit("8")).alias("last_field"))


@query
def odd_folder_names(spark, sf_dir):
    """Entity and folder of the landed files, names with a blank, a plus and a percent sign among them."""
    settings = faulty_landing(spark, sf_dir).settings
    files = landing.with_entity(landing.landed_files(spark, settings.landed(settings.daily_glob)), settings)
    return files.select("ticker", "folder")


@query
def wide_refresh_summary(spark, sf_dir):
    """Summary of a refresh of all suppliers, of whom only a part trades on the base date."""
    table = wide(spark, sf_dir).store.read("gold", "ticker_summary", run_id=WIDE_RUN)
    return _summary_columns(table.drop("source_ingested_at", "built_at"))


@query
def wide_refresh_checks(spark, sf_dir):
    results = wide(spark, sf_dir).table("ops", "dq_results").where(F.col("pipeline_run_id") == WIDE_RUN)
    return results.select(*RESULT)


# ---------------------------------------------------------------- landed files and published tables


@query
def landing_report(spark, sf_dir):
    return landing.landing_report(spark, published(spark, sf_dir).settings)


@query
def landed_headers(spark, sf_dir):
    heads = landing.read_headers(spark, published(spark, sf_dir).settings)
    return heads.groupBy("ticker").agg(F.bool_and("header_ok").alias("header_ok"), F.max("header").alias("header"))


@query
def landed_line_counts(spark, sf_dir):
    settings = published(spark, sf_dir).settings
    counts = landing.with_entity(landing.line_counts(spark, settings.landed(settings.daily_glob)), settings)
    return counts.groupBy("ticker").agg(F.sum("data_rows").alias("data_rows"))


@query
def landed_summaries(spark, sf_dir):
    table = published(spark, sf_dir).store.read("bronze", "source_run_summary", run_id=GOOD_RUN)
    return table.select(
        "ticker", "source_symbol", "stock", "source_run_id", "daily_rows", "daily_date_max", "daily_duplicate_dates",
        "raw_json",
    )


@query
def raw_bars(spark, sf_dir):
    raw = published(spark, sf_dir).store.read("bronze", "daily_prices_raw", run_id=GOOD_RUN)
    return raw.select("ticker", "source_date", "volume", "ingested_at_utc", "pipeline_run_id", "_rescued_data")


@query
def raw_profile(spark, sf_dir):
    return reconcile.raw_profile(published(spark, sf_dir).store.read("bronze", "daily_prices_raw", run_id=GOOD_RUN))


@query
def raw_rows_of_first_date(spark, sf_dir):
    raw = published(spark, sf_dir).store.read("bronze", "daily_prices_raw", run_id=GOOD_RUN)
    rows = reconcile.raw_rows_of(raw, raw.agg(F.min("source_date")).scalar())
    return rows.select("ticker", "source_date", "volume")


@query
def published_bars(spark, sf_dir):
    silver = published(spark, sf_dir).store.read("silver", "daily_prices", run_id=GOOD_RUN)
    return silver.drop("source_file", "processed_at").withColumn(
        "source_ingested_at", F.unix_micros("source_ingested_at")
    )


@query
def published_daily(spark, sf_dir):
    return _daily_columns(published(spark, sf_dir).store.read("gold", "fact_daily_metrics", run_id=GOOD_RUN))


@query
def published_summary(spark, sf_dir):
    table = published(spark, sf_dir).store.read("gold", "ticker_summary", run_id=GOOD_RUN)
    return _summary_columns(table.drop("source_ingested_at", "built_at"))


@query
def run_audit(spark, sf_dir):
    audit = published(spark, sf_dir).table("ops", "run_audit").filter(F.col("pipeline_run_id") == GOOD_RUN)
    latest = [reconcile.latest_audit(audit, task, 1) for task in ("bronze_ingest", "silver_transform", "gold_build")]
    return latest[0].unionByName(latest[1]).unionByName(latest[2]).drop("started_at", "ended_at")


@query
def run_check_results(spark, sf_dir):
    results = published(spark, sf_dir).table("ops", "dq_results").filter(F.col("pipeline_run_id") == GOOD_RUN)
    return results.select("pipeline_run_id", *RESULT)


@query
def latest_results(spark, sf_dir):
    """The newest fourteen result rows of each layer after the good run."""
    results = published(spark, sf_dir).table("ops", "dq_results").filter(F.col("pipeline_run_id") == GOOD_RUN)
    newest = [reconcile.latest_results(results, layer, n) for layer, n in (("bronze", 6), ("silver", 14), ("gold", 10))]
    return reduce(DataFrame.unionByName, newest).select("pipeline_run_id", "check_name", "severity", "passed", "failing_count")


@query
def recovery_run_audit(spark, sf_dir):
    audit = reconcile.audit_of_run(recovered(spark, sf_dir).table("ops", "run_audit"), RECOVERY_RUN)
    return audit.select("task_name", "status", "rows_in", "rows_out", "rows_rejected", "error_message")


@query
def check_failures(spark, sf_dir):
    """Every failing item that the run over the planted duplicate has recorded."""
    found = recovered(spark, sf_dir).table("ops", "check_failures").where(F.col("pipeline_run_id") == FAULTY_RUN)
    value = F.when(F.col("value").startswith("open="), F.lit("row")).otherwise(F.col("value"))
    return found.select("check_name", "layer", "entity", "trade_date", value.alias("value"))


@query
def table_comments(spark, sf_dir):
    """Measure tables, whether they are described, and their rows."""
    work = published(spark, sf_dir)
    tables = table_metadata(spark, work.settings, "gold").select("table_name", F.col("comment").isNotNull().alias("described"))
    rows = reconcile.table_counts({name: work.store.read("gold", name, run_id=GOOD_RUN) for name in GOLD_KEYS})
    return tables.join(rows, "table_name")


@query
def commented_columns(spark, sf_dir):
    """Per measure table: its columns, the described ones, and the key values of its rows."""
    work = published(spark, sf_dir)
    counted = reconcile.commented_columns(column_metadata(spark, work.settings, "gold"))
    tables = {name: work.store.read("gold", name, run_id=GOOD_RUN) for name in GOLD_KEYS}
    return counted.join(reconcile.table_key_counts(tables, GOLD_KEYS).drop("n_rows"), "table_name")


@query
def comments_of_summary(spark, sf_dir):
    """The columns of the summary table, whether they are described, and how many rows have a value in them."""
    work = published(spark, sf_dir)
    listed = reconcile.comments_of(column_metadata(spark, work.settings, "gold"), "ticker_summary")
    table = work.store.read("gold", "ticker_summary", run_id=GOOD_RUN)
    filled = table.agg(*[F.count(c).alias(c) for c in table.columns]).unpivot([], table.columns, "column_name", "n_values")
    return listed.select("column_name", F.col("comment").isNotNull().alias("described")).join(filled, "column_name")


@query
def failed_run_audit(spark, sf_dir):
    audit = reconcile.audit_of_run(recovered(spark, sf_dir).table("ops", "run_audit"), FAULTY_RUN)
    names_check = F.col("error_message").contains("silver_no_duplicate_keys").alias("names_the_check")
    return audit.select("task_name", "status", "rows_in", "rows_out", "rows_rejected", names_check)


@query
def failed_run_results(spark, sf_dir):
    return reconcile.results_of_run(recovered(spark, sf_dir).table("ops", "dq_results"), FAULTY_RUN)


@query
def raw_origin_of_runs(spark, sf_dir):
    """Duplicated keys and fixture files in the raw table as the failed run and the recovery run left it."""
    store = recovered(spark, sf_dir).store
    patterns = {"fixture_files": "%/test_fixtures/%", "real_files": "%/landing/%"}
    rows = []
    for run in (FAULTY_RUN, RECOVERY_RUN):
        raw = store.read("bronze", "daily_prices_raw", run_id=run)
        row = reconcile.raw_origin(raw, **patterns)
        rows.append(
            row.select(
                F.lit(run).alias("run_id"),
                "duplicated_keys",
                (F.col("fixture_files") > 0).alias("has_fixture_files"),
                (F.col("real_files") > 0).alias("has_real_files"),
            )
        )
    return rows[0].unionByName(rows[1])


@query
def last_good_runs(spark, sf_dir):
    """The run each table came from while the failed run was the latest: the version before the recovery."""
    store = recovered(spark, sf_dir).store
    named = {"silver.daily_prices": ("silver", "daily_prices")}
    named.update({f"gold.{name}": ("gold", name) for name in GOLD_KEYS})
    return reconcile.runs_per_table({label: store.read(*t, version=0) for label, t in named.items()})


@query
def version_history(spark, sf_dir):
    """Every published version with its rows and the entities in them."""
    store = recovered(spark, sf_dir).store
    parts = []
    for layer, name in COMPARED:
        for row in store.history(layer, name).collect():  # one row per version
            table = store.read(layer, name, version=row["version"])
            parts.append(
                table.agg(F.count("*").alias("n_rows"), F.count_distinct("ticker").alias("n_entities")).select(
                    F.lit(layer).alias("layer"),
                    F.lit(name).alias("name"),
                    F.lit(row["version"]).alias("version"),
                    F.lit(row["pipeline_run_id"]).alias("pipeline_run_id"),
                    F.lit(row["task_name"]).alias("task_name"),
                    "n_rows",
                    "n_entities",
                )
            )
    return reduce(DataFrame.unionByName, parts)


@query
def recovered_returns(spark, sf_dir):
    """Total returns after the recovery next to those of the good run."""
    store = recovered(spark, sf_dir).store
    before = store.read("gold", "ticker_summary", run_id=GOOD_RUN)
    after = store.read("gold", "ticker_summary", run_id=RECOVERY_RUN)
    expected = before.select("ticker", F.col("total_return").alias("expected_total_return"))
    compared = reconcile.against_expected(after, expected)
    return rounded(_agreeing(compared), "total_return", "expected_total_return")


@query
def rerun_report(spark, sf_dir):
    """The latest two versions of every table after the recovery. The raw bars differ, since the version before the
    latest holds the planted duplicate; all others repeat."""
    report = compare_runs(spark, recovered(spark, sf_dir).settings)
    return rounded(report.drop("note"), "max_double_diff").withColumn(
        "table", F.regexp_replace("table", r"^spark_catalog\.([a-z]+)_[0-9a-f]+\.", "$1.")
    )
