"""The checks of each layer. Names, severities and rules are fixed; the wording of expected and details is free.

Each layer has two functions: one gives the results, a row per check; the other, a frame of failing items per check,
which only the failed checks' frames are read of. Details carry numbers; the items are in the failures table, all of
them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.columns import any_of, compounded, holds
from barloom.operators.flags import base_date
from barloom.operators.lineage import source_lineage
from barloom.operators.quality import CRITICAL, INFO, WARN, Check, count_rules, evaluate, failing
from barloom.operators.validate import duplicate_keys, reason_histogram
from barloom.spec import NORMAL, PRICE_COLUMNS, ZERO_ALL, ZERO_PARTIAL, PanelSpec

# Tolerances of the identities.
INDEX_TOLERANCE = 1e-9
DRAWDOWN_TOLERANCE = 1e-12
COMPOUND_TOLERANCE = 1e-9


def _text(label: str, value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.concat(F.lit(f"{label}="), F.coalesce(value.cast("string"), F.lit("NULL")))


def _joined(*parts: Column) -> Column:
    return F.concat_ws(" ", *parts)


# ---------------------------------------------------------------- bronze


def landing_by_entity(universe: DataFrame, daily: DataFrame, summaries: DataFrame, headers: DataFrame) -> DataFrame:
    """One row per configured entity: what landed for it. ``headers`` has (ticker, header_ok).

    Daily rows are counted per entity before any join, so the joins see one row per entity on every side.
    """
    counted = daily.groupBy("ticker").agg(F.count("*").alias("csv_rows"))
    declared = summaries.groupBy("ticker").agg(
        F.max("source_symbol").alias("json_symbol"),
        F.max("daily_rows").alias("json_rows"),
        F.count("*").alias("n_summaries"),
    )
    heads = headers.groupBy("ticker").agg(F.bool_and("header_ok").alias("header_ok"))
    landed = universe.select("ticker", "source_symbol")
    for part in (counted, declared, heads):
        landed = landed.join(part, "ticker", "left")
    return landed


# What is wrong with an entity's landed files, and how a failing one is described.
LANDING_FAULTS = {
    "bronze_all_tickers_present": (
        lambda: F.col("csv_rows").isNull() | F.col("n_summaries").isNull(),
        lambda: _joined(_text("csv_rows", "csv_rows"), _text("summaries", "n_summaries")),
    ),
    "bronze_header_matches": (lambda: ~holds(F.col("header_ok")), lambda: _text("header_ok", "header_ok")),
    "bronze_rows_match_run_summary": (
        lambda: F.col("csv_rows").isNull() | ~F.col("csv_rows").eqNullSafe(F.col("json_rows")),
        lambda: _joined(_text("landed", "csv_rows"), _text("declared", "json_rows")),
    ),
    "bronze_source_symbol_matches": (
        lambda: ~F.col("source_symbol").eqNullSafe(F.col("json_symbol")),
        lambda: _joined(_text("configured", "source_symbol"), _text("declared", "json_symbol")),
    ),
}
LANDING_EXPECTED = {
    "bronze_header_matches": "no mismatch",
    "bronze_rows_match_run_summary": "landed rows equal declared rows",
    "bronze_source_symbol_matches": "declared symbol equals configured symbol",
}


def bronze_checks(universe: DataFrame, daily: DataFrame, summaries: DataFrame, headers: DataFrame) -> DataFrame:
    """A landed row that belongs to no entity counts as an absent one."""
    per_entity = landing_by_entity(universe, daily, summaries, headers)
    entities = count_rules(
        per_entity,
        {name: fault() for name, (fault, _) in LANDING_FAULTS.items()},
        n_entities=F.count("*"),
    )
    rows = count_rules(daily, {"rescued": F.col("_rescued_data").isNotNull(), "unnamed": F.col("ticker").isNull()})
    measured = entities.withColumn("unnamed", rows.select("unnamed").scalar())
    checks = []
    for name in LANDING_FAULTS:
        count = F.col(name)
        if name == "bronze_all_tickers_present":
            count, expected = count + F.col("unnamed"), F.col("n_entities").cast("string")
            details = _joined(_text("absent", name), _text("rows of no entity", "unnamed"))
        else:
            expected, details = LANDING_EXPECTED[name], _text("entities", name)
        checks.append(Check(name, CRITICAL, count, expected, details))
    runs = summaries.agg(
        (
            F.count_distinct("source_run_id")
            + F.coalesce(F.bool_or(F.col("source_run_id").isNull()).cast("int"), F.lit(0))
        ).alias("n_runs")
    )
    one_run = Check(
        "bronze_single_source_run_id", WARN, F.abs(F.col("n_runs") - 1), "1", _text("distinct source runs", "n_runs")
    )
    no_rescue = Check("bronze_rescued_data_empty", WARN, F.col("rescued"), "0", _text("rescued rows", "rescued"))
    return (
        evaluate(measured, "bronze", checks)
        .unionByName(evaluate(runs, "bronze", [one_run]))
        .unionByName(evaluate(rows, "bronze", [no_rescue]))
    )


def bronze_failures(
    universe: DataFrame, daily: DataFrame, summaries: DataFrame, headers: DataFrame
) -> dict[str, DataFrame]:
    per_entity = landing_by_entity(universe, daily, summaries, headers)
    found = {
        name: failing(name, "bronze", per_entity.where(fault()), "ticker", None, value())
        for name, (fault, value) in LANDING_FAULTS.items()
    }
    present, header, run = "bronze_all_tickers_present", "bronze_header_matches", "bronze_single_source_run_id"
    unnamed = daily.where("ticker IS NULL").groupBy("source_file").agg(F.count("*").alias("n"))
    found[present] = found[present].unionByName(
        failing(present, "bronze", unnamed, F.lit(None), None, _joined(F.col("source_file"), _text("rows", "n")))
    )
    bad_files = headers.where("NOT header_ok")
    found[header] = failing(header, "bronze", bad_files, "ticker", None, _joined(F.col("path"), _text("header", "header")))
    runs = summaries.groupBy("source_run_id").agg(F.count("*").alias("n"))
    found[run] = failing(run, "bronze", runs, F.lit(None), None, _joined(_text("run", "source_run_id"), _text("summaries", "n")))
    rescue = "bronze_rescued_data_empty"
    found[rescue] = failing(
        rescue, "bronze", daily.where("_rescued_data IS NOT NULL"), "ticker", "source_date", F.col("_rescued_data")
    )
    return found


# ---------------------------------------------------------------- silver


def date_set_gaps(panel: DataFrame, profile: DataFrame, universe: DataFrame, spec: PanelSpec) -> DataFrame:
    """Configured entities that do not have every date of the panel: (entity, n_dates, n_union)."""
    n_union = panel.select(spec.date).distinct().agg(F.count("*")).scalar()
    return (
        universe.select(F.col("ticker").alias(spec.entity))
        .join(profile.select(spec.entity, "n_dates"), spec.entity, "left")
        .withColumn("n_dates", F.coalesce("n_dates", F.lit(0)))
        .withColumn("n_union", n_union)
        .filter(F.col("n_dates") != F.col("n_union"))
    )


def row_rules(spec: PanelSpec = PanelSpec()) -> dict[str, Column]:
    """Check name to the condition that a failing silver row meets."""
    required = [*spec.key, *PRICE_COLUMNS, "volume", "volume_status"]
    return {
        "silver_no_nulls": any_of(F.col(c).isNull() for c in required),
        "silver_positive_prices": any_of(F.col(c) <= 0 for c in PRICE_COLUMNS),
        "silver_ohlc_valid": (F.col("low") > F.least("open", "close")) | (F.col("high") < F.greatest("open", "close")),
        "silver_volume_non_negative": F.col("volume") < 0,
        "silver_zero_partial_count": F.col("volume_status") == ZERO_PARTIAL,
        "silver_zero_all_tickers_count": F.col("volume_status") == ZERO_ALL,
        "silver_source_ingested_at_parsed": F.col("source_ingested_at").isNull(),
    }


def silver_checks(
    silver: DataFrame,
    quarantine: DataFrame,
    profile: DataFrame,
    universe: DataFrame,
    n_entities: int,
    bronze_rows: Column,
    spec: PanelSpec = PanelSpec(),
) -> DataFrame:
    """``silver`` and ``quarantine`` are the staged tables, ``profile`` the stored ``entity_profile`` of silver, and
    ``bronze_rows`` a scalar."""
    rows = count_rules(silver, row_rules(spec), silver_rows=F.count("*")).select(
        "*", quarantine.agg(F.count("*")).scalar().alias("quarantine_rows"), bronze_rows.alias("bronze_rows")
    )
    base = base_date(silver, n_entities, spec).scalar()
    about = {
        "silver_no_nulls": (CRITICAL, "key, prices, volume and status are set"),
        "silver_positive_prices": (CRITICAL, "rows"),
        "silver_ohlc_valid": (CRITICAL, "open and close lie between low and high"),
        "silver_volume_non_negative": (CRITICAL, "rows"),
        "silver_zero_partial_count": (WARN, "rows without volume while others trade"),
        "silver_zero_all_tickers_count": (INFO, "rows of dates without any volume"),
        "silver_source_ingested_at_parsed": (WARN, "rows without a parsed source time"),
    }
    counted = _joined(_text("bronze", "bronze_rows"), _text("silver", "silver_rows"), _text("quarantine", "quarantine_rows"))
    from_rows = [
        Check("silver_reconciles_with_bronze", CRITICAL,
              F.abs(F.col("bronze_rows") - F.col("silver_rows") - F.col("quarantine_rows")),
              "valid plus quarantined rows equal bronze rows", counted),
        *[Check(name, severity, F.col(name), "informational" if severity == INFO else "0", text)
          for name, (severity, text) in about.items()],
        Check("silver_quarantine_empty", WARN, F.col("quarantine_rows"), "0", _text("rows", "quarantine_rows")),
        Check("silver_base_date", INFO, F.lit(0), "informational", _text("base_date", base)),
    ]
    from_profile = [
        Check("silver_no_duplicate_keys", CRITICAL, F.col("duplicated"), "0", _text("keys", "duplicated")),
        Check("silver_zero_volume_rows_flat", WARN, F.col("not_flat"), "0", "one price, equal to the previous close"),
        Check("silver_flat_rows_adjclose_carried", WARN, F.col("not_carried"), "0", "previous adjclose repeated"),
    ]
    totals = profile.agg(
        *[F.coalesce(F.sum(f"n_{name}"), F.lit(0)).alias(name) for name in ("duplicated", "not_flat", "not_carried")]
    )
    gaps = date_set_gaps(silver, profile, universe, spec).agg(F.count("*").alias("n"))
    same_dates = Check(
        "silver_same_date_set", WARN, F.col("n"), "every entity has every date of the panel", _text("entities", "n")
    )
    return (
        evaluate(rows, "silver", from_rows)
        .unionByName(evaluate(totals, "silver", from_profile))
        .unionByName(evaluate(gaps, "silver", [same_dates]))
    )


def silver_failures(
    silver: DataFrame, quarantine: DataFrame, profile: DataFrame, universe: DataFrame, spec: PanelSpec = PanelSpec()
) -> dict[str, DataFrame]:
    shown = _joined(*[_text(c, c) for c in (*PRICE_COLUMNS, "volume")])
    found = {
        name: failing(name, "silver", silver.where(rule), spec.entity, spec.date, shown)
        for name, rule in row_rules(spec).items()
    }
    empty, twice, gaps = "silver_quarantine_empty", "silver_no_duplicate_keys", "silver_same_date_set"
    reasons = reason_histogram(quarantine)
    found[empty] = failing(empty, "silver", reasons, F.lit(None), None, _joined(F.col("reason"), _text("rows", "n_rows")))
    copies = duplicate_keys(silver, *spec.key)
    found[twice] = failing(twice, "silver", copies, spec.entity, spec.date, _text("copies", "count"))
    short = date_set_gaps(silver, profile, universe, spec)
    found[gaps] = failing(
        gaps, "silver", short, spec.entity, None, _joined(_text("dates", "n_dates"), _text("of", "n_union"))
    )
    for name, column in (
        ("silver_zero_volume_rows_flat", "n_not_flat"),
        ("silver_flat_rows_adjclose_carried", "n_not_carried"),
    ):
        found[name] = failing(name, "silver", profile.where(F.col(column) > 0), spec.entity, None, _text("rows", column))
    return found


# ---------------------------------------------------------------- gold


def daily_profile(daily: DataFrame, base: Column, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """One row per entity of the daily table: n_rows, n_duplicated (keys), n_positive (drawdowns), has_base,
    base_index, last_index, and leading (normal rows before the first volatility, all of them if there is none).

    Copies of a key are merged first; one row per key then moves by entity, for the running count and the grouping.
    """
    day = F.col(spec.date)
    keyed = (
        daily.select(*spec.key, "normalized_index", "drawdown", "vol_60d_ann", "volume_status")
        .groupBy(*spec.key)
        .agg(
            F.count("*").alias("copies"),
            F.max("normalized_index").alias("index"),
            F.count_if(F.col("drawdown") > DRAWDOWN_TOLERANCE).alias("positive"),
            F.count("vol_60d_ann").alias("measured"),
            F.count_if(F.col("volume_status") == NORMAL).alias("normal"),
        )
    )
    so_far = Window.partitionBy(spec.entity).orderBy(spec.date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        keyed.withColumn("warm", F.sum("measured").over(so_far) > 0)
        .groupBy(spec.entity)
        .agg(
            F.sum("copies").alias("n_rows"),
            F.count_if(F.col("copies") > 1).alias("n_duplicated"),
            F.sum("positive").alias("n_positive"),
            F.max(day == base).alias("has_base"),
            F.max(F.when(day == base, F.col("index"))).alias("base_index"),
            F.max_by("index", spec.date).alias("last_index"),
            F.sum(F.when(F.col("warm"), 0).otherwise(F.col("normal"))).alias("leading"),
        )
    )


def year_products(monthly: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    return monthly.groupBy(spec.entity, F.year("month_start").alias("year")).agg(
        compounded(F.col("monthly_return")).alias("compound")
    )


def _gold_faults(
    tables: dict[str, DataFrame], profile: DataFrame, universe: DataFrame, spec: PanelSpec
) -> dict[str, DataFrame]:
    """The failing rows of the checks that compare entities. With a coverage below 1, an entity without a bar on the
    base date has neither index nor total return, and its first year none to compound to; at full coverage it is a
    fault."""
    entities = universe.select(F.col("ticker").alias(spec.entity))
    here = entities.join(profile, spec.entity, "left")
    started_late = ~holds(F.col("has_base")) & F.lit(spec.min_coverage < 1)
    off_index = ~holds(F.abs(F.col("base_index") - 100) <= INDEX_TOLERANCE) & ~started_late

    with_index = tables["ticker_summary"].join(profile.select(spec.entity, "has_base", "last_index"), spec.entity, "left")
    neither = F.col("total_return").isNull() & F.col("last_index").isNull()
    same_return = holds(F.abs(F.col("total_return") - (F.col("last_index") / 100 - 1)) <= INDEX_TOLERANCE)

    years = (
        tables["fact_yearly_metrics"]
        .join(year_products(tables["fact_monthly_metrics"], spec), [spec.entity, "year"], "left")
        .join(profile.select(spec.entity, "has_base"), spec.entity, "left")
    )
    compounds = holds(F.abs(F.col("compound") - (1 + F.col("yearly_return"))) <= COMPOUND_TOLERANCE)

    in_summary = tables["ticker_summary"].groupBy(spec.entity).agg(F.count("*").alias("copies"))
    listed = entities.withColumn("configured", F.lit(1)).join(in_summary, spec.entity, "full")
    listed = listed.select(
        spec.entity, F.coalesce("configured", F.lit(0)).alias("configured"), F.coalesce("copies", F.lit(0)).alias("copies")
    )
    return {
        "gold_index_100_at_base": here.where(off_index),
        "gold_total_return_consistent": with_index.where(~same_return & ~(neither & started_late)),
        "gold_monthly_compounds_to_yearly": years.where(~compounds & ~(F.col("yearly_return").isNull() & started_late)),
        "gold_summary_four_rows": listed.where("copies != configured"),
        "gold_vol_leading_nulls": here.where(F.coalesce("leading", F.lit(0)) != spec.vol_window),
    }


def gold_checks(
    tables: dict[str, DataFrame],
    silver: DataFrame,
    universe: DataFrame,
    base: Column,
    keys: dict[str, list[str]],
    profile: DataFrame,
    spec: PanelSpec = PanelSpec(),
) -> DataFrame:
    """``tables`` are the five staged tables by name and ``profile`` the stored ``daily_profile`` of the daily one; a
    comparison that comes out NULL counts as failing."""
    monthly, yearly = tables["fact_monthly_metrics"], tables["fact_yearly_metrics"]
    faults = _gold_faults(tables, profile, universe, spec)

    copies = profile.agg(F.lit("fact_daily_metrics").alias("name"), F.coalesce(F.sum("n_duplicated"), F.lit(0)).alias("n"))
    for name in keys.keys() - {"fact_daily_metrics"}:
        counted = duplicate_keys(tables[name], *keys[name]).agg(F.lit(name).alias("name"), F.count("*").alias("n"))
        copies = copies.unionByName(counted)
    listed = F.array_sort(F.collect_list(F.concat_ws(":", "name", F.col("n").cast("string"))))  # one entry per table
    copies = copies.agg(F.sum("n").alias("n"), F.array_join(listed, ", ").alias("per_table"))
    unique = Check("gold_unique_keys", CRITICAL, F.col("n"), "no duplicated key", _text("per table", "per_table"))

    no_base = F.count_if(~holds(F.col("has_base"))).alias("no_base")
    totals = profile.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("gold_rows"), F.coalesce(F.sum("n_positive"), F.lit(0)).alias("positive"), no_base
    ).withColumn("silver_rows", silver.filter(F.col(spec.date) >= base).agg(F.count("*")).scalar())
    from_profile = [
        Check("gold_daily_rows_match_silver", CRITICAL, F.abs(F.col("gold_rows") - F.col("silver_rows")),
              "daily rows equal silver rows from the base date",
              _joined(_text("gold", "gold_rows"), _text("silver", "silver_rows"), _text("base_date", base))),
        Check("gold_drawdown_non_positive", CRITICAL, F.col("positive"), "0", f"rows above {DRAWDOWN_TOLERANCE}"),
    ]
    late = totals.select("no_base").scalar()
    compared = {
        "gold_index_100_at_base": (
            CRITICAL, "100 for every entity", _joined(_text("off", "n"), _text("without a base bar", late))),
        "gold_summary_four_rows": (CRITICAL, "exactly the configured entities", _text("entities off", "n")),
        "gold_total_return_consistent": (CRITICAL, "total return equals last index / 100 - 1", _text("off", "n")),
        "gold_monthly_compounds_to_yearly": (
            WARN, f"no entity-year off by more than {COMPOUND_TOLERANCE}", _text("off", "n")),
        "gold_vol_leading_nulls": (
            WARN, f"{spec.vol_window} normal rows per entity before the first value", _text("differing", "n")),
    }
    one_run = Check(
        "gold_single_source_run_id", CRITICAL, F.abs(F.col("n_runs") - 1), "1", _text("distinct source runs", "n_runs")
    )
    partial = monthly.agg(F.count_if("is_partial").alias("months")).withColumn(
        "years", yearly.agg(F.count_if("is_partial")).scalar()
    )
    partial_check = Check(
        "gold_partial_periods", INFO, F.col("months") + F.col("years"), "informational",
        _joined(_text("months", "months"), _text("years", "years")),
    )
    parts = [
        (copies, [unique]),
        (totals, from_profile),
        *[(faults[name].agg(F.count("*").alias("n")), [Check(name, severity, F.col("n"), expected, details)])
          for name, (severity, expected, details) in compared.items()],
        (source_lineage(silver), [one_run]),
        (partial, [partial_check]),
    ]
    results = None
    for measures, checks in parts:
        rows = evaluate(measures, "gold", checks)
        results = rows if results is None else results.unionByName(rows)
    return results


def gold_failures(
    tables: dict[str, DataFrame],
    silver: DataFrame,
    universe: DataFrame,
    keys: dict[str, list[str]],
    profile: DataFrame,
    spec: PanelSpec = PanelSpec(),
) -> dict[str, DataFrame]:
    faults = _gold_faults(tables, profile, universe, spec)
    described = {
        "gold_index_100_at_base": _text("index", "base_index"),
        "gold_total_return_consistent": _joined(_text("total_return", "total_return"), _text("last_index", "last_index")),
        "gold_monthly_compounds_to_yearly": _joined(_text("year", "year"), _text("compound", "compound"), _text("return", "yearly_return")),
        "gold_summary_four_rows": _joined(_text("configured", "configured"), _text("rows", "copies")),
        "gold_vol_leading_nulls": _text("leading", "leading"),
    }
    found = {
        name: failing(name, "gold", faults[name], spec.entity, None, value) for name, value in described.items()
    }
    unique, drawdown, runs, partial = (
        "gold_unique_keys", "gold_drawdown_non_positive", "gold_single_source_run_id", "gold_partial_periods",
    )
    for name, key in keys.items():
        period = next((c for c in key if c != spec.entity), None)
        rows = failing(
            unique, "gold", duplicate_keys(tables[name], *key), spec.entity, period, _joined(F.lit(name), _text("copies", "count"))
        )
        found[unique] = found[unique].unionByName(rows) if unique in found else rows
    daily = tables["fact_daily_metrics"]
    found[drawdown] = failing(
        drawdown, "gold", daily.where(F.col("drawdown") > DRAWDOWN_TOLERANCE), spec.entity, spec.date, F.col("drawdown")
    )
    sources = silver.groupBy("source_run_id").agg(F.count("*").alias("n"))
    found[runs] = failing(runs, "gold", sources, F.lit(None), None, _joined(_text("run", "source_run_id"), _text("rows", "n")))
    periods = (
        tables["fact_monthly_metrics"].where("is_partial").select(spec.entity, F.lit(1).alias("month"), F.lit(0).alias("year"))
        .unionByName(tables["fact_yearly_metrics"].where("is_partial").select(spec.entity, F.lit(0).alias("month"), F.lit(1).alias("year")))
        .groupBy(spec.entity).agg(F.sum("month").alias("months"), F.sum("year").alias("years"))
    )
    found[partial] = failing(
        partial, "gold", periods, spec.entity, None, _joined(_text("months", "months"), _text("years", "years"))
    )
    return found
