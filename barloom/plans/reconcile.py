"""Validation and reconciliation queries over the layers.

The reconciliations compute a measure again from the silver bars, by another route than the operators that build it, and
put the published value and the difference next to it.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.episodes import drawdown_episodes
from barloom.operators.validate import duplicate_keys
from barloom.spec import NORMAL, ZERO_ALL, ZERO_PARTIAL, PanelSpec

# ---------------------------------------------------------------- bronze


def raw_profile(raw: DataFrame) -> DataFrame:
    """Per entity: rows, runs, first and last source date, rescued rows. Rows are merged per entity and run first, so
    that counting the runs needs no distinct aggregate."""
    per_run = raw.groupBy("ticker", "pipeline_run_id").agg(
        F.struct(
            F.count("*").alias("rows"),
            F.count("_rescued_data").alias("rescued"),
            F.min("source_date").alias("first"),
            F.max("source_date").alias("last"),
        ).alias("r")
    )
    return per_run.groupBy("ticker").agg(
        F.sum("r.rows").alias("n_rows"),
        F.count("pipeline_run_id").alias("n_runs"),
        F.min("r.first").alias("min_date"),
        F.max("r.last").alias("max_date"),
        F.sum("r.rescued").alias("rescued_rows"),
    )


def raw_rows_of(raw: DataFrame, source_date: str | Column) -> DataFrame:
    return raw.filter(F.col("source_date") == source_date).orderBy("ticker")


# ---------------------------------------------------------------- history tables


def latest_audit(audit: DataFrame, task: str, n: int) -> DataFrame:
    return audit.filter(F.col("task_name") == task).orderBy(F.col("started_at").desc()).limit(n)


def latest_results(results: DataFrame, layer: str, n: int) -> DataFrame:
    return (
        results.filter(F.col("layer") == layer)
        .select("pipeline_run_id", "check_name", "severity", "passed", "failing_count", "expected", "details", "checked_at")
        .orderBy(F.col("checked_at").desc(), "check_name")
        .limit(n)
    )


def audit_of_run(audit: DataFrame, job_run_id: str) -> DataFrame:
    columns = ["task_name", "status", "rows_in", "rows_out", "rows_rejected", "error_message", "started_at", "ended_at"]
    return audit.filter(F.col("job_run_id") == job_run_id).select(*columns).orderBy("started_at")


def results_of_run(results: DataFrame, run_id: str) -> DataFrame:
    columns = ["layer", "check_name", "severity", "passed", "failing_count", "details"]
    return results.filter(F.col("pipeline_run_id") == run_id).select(*columns).orderBy("layer", "passed", "check_name")


def raw_origin(raw: DataFrame, **like_patterns: str) -> DataFrame:
    """One row: duplicated raw keys, and distinct source files matching each named LIKE pattern."""
    copies = duplicate_keys(raw, "ticker", "source_date").agg(F.count("*")).scalar()
    path = F.col("source_file")
    return raw.agg(
        *[F.count_distinct(F.when(path.like(p), path)).alias(name) for name, p in like_patterns.items()]
    ).select(copies.alias("duplicated_keys"), *like_patterns)


def runs_per_table(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and run ids of each table, to see that all still come from one run."""
    parts = [
        frame.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("n_rows"),
            F.count_distinct("pipeline_run_id").alias("n_run_ids"),
            F.min("pipeline_run_id").alias("pipeline_run_id"),
        )
        for name, frame in tables.items()
    ]
    return _stack(parts)


def against_expected(summary: DataFrame, expected: DataFrame) -> DataFrame:
    """Published total returns next to recorded ones; ``expected`` is (ticker, expected_total_return)."""
    return (
        summary.join(expected, "ticker")
        .select(
            "ticker",
            "pipeline_run_id",
            "total_return",
            "expected_total_return",
            F.abs(F.col("total_return") - F.col("expected_total_return")).alias("abs_diff"),
        )
        .orderBy("ticker")
    )


# ---------------------------------------------------------------- silver


def status_counts(silver: DataFrame) -> DataFrame:
    status = F.col("volume_status")
    return (
        silver.groupBy("ticker")
        .agg(
            F.count("*").alias("n_rows"),
            F.count_if(status == NORMAL).alias("normal"),
            F.count_if(status == ZERO_ALL).alias("zero_all_tickers"),
            F.count_if(status == ZERO_PARTIAL).alias("zero_partial"),
        )
        .orderBy("ticker")
    )


def key_counts(frame: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows and distinct keys. Keys are merged per key first, so no single task gathers them all."""
    return (
        frame.groupBy(*keys)
        .agg(F.count("*").alias("copies"))
        .agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"), F.count("*").alias("distinct_keys"))
    )


def quarantine_reasons(quarantine: DataFrame) -> DataFrame:
    counted = quarantine.groupBy("reject_reason").agg(F.count("*").alias("n_rows"))
    return counted.orderBy(F.col("n_rows").desc(), "reject_reason")


def zero_partial_rows(silver: DataFrame) -> DataFrame:
    return (
        silver.filter(F.col("volume_status") == ZERO_PARTIAL)
        .select("trade_date", "ticker", "open", "high", "low", "close", "volume")
        .orderBy("trade_date", "ticker")
    )


# ---------------------------------------------------------------- gold


def _stack(parts: list[DataFrame]) -> DataFrame:
    stacked, *rest = parts
    for part in rest:
        stacked = stacked.unionByName(part)
    return stacked


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _stack(
        [t.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows")) for name, t in tables.items()]
    )


def table_key_counts(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    return _stack(
        [
            key_counts(tables[name], key).select(
                F.lit(name).alias("table_name"),
                F.col("total_rows").alias("n_rows"),
                F.col("distinct_keys").alias("n_keys"),
            )
            for name, key in keys.items()
        ]
    )


def partial_period_counts(monthly: DataFrame, yearly: DataFrame) -> DataFrame:
    """Both tables stacked and grouped once."""
    kinds = {"partial_months": monthly, "partial_years": yearly}
    stacked = _stack([t.select("ticker", "is_partial", F.lit(kind).alias("kind")) for kind, t in kinds.items()])
    return stacked.groupBy("ticker").agg(
        *[F.count_if(F.col("is_partial") & (F.col("kind") == kind)).alias(kind) for kind in kinds]
    )


def _with_first_volatility(daily: DataFrame, spec: PanelSpec) -> DataFrame:
    """Each daily row with the entity's first date that has a volatility."""
    measured = F.when(F.col("vol_60d_ann").isNotNull(), F.col(spec.date))
    return daily.withColumn("first_vol", F.min(measured).over(Window.partitionBy(spec.entity)))


def leading_null_rows(daily: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Normal rows before the first volatility, for the entities that have one."""
    early = _with_first_volatility(daily, spec).where(
        (F.col(spec.date) < F.col("first_vol")) & (F.col("volume_status") == NORMAL)
    )
    return early.groupBy(spec.entity).agg(F.count("*").alias("leading_null_normal_rows"))


def null_vol_after_warmup(daily: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Rows without a volatility after the entity's first one, by status: only flagged rows should be listed."""
    late = _with_first_volatility(daily, spec).where(f"vol_60d_ann IS NULL AND {spec.date} > first_vol")
    return late.groupBy(spec.entity, "volume_status").agg(
        F.count("*").alias("null_vol_rows"),
        F.min(spec.date).alias("first_date"),
        F.max(spec.date).alias("last_date"),
    )


def peak_and_trough_rows(summary: DataFrame, daily: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """The daily rows at the reported peak and trough: the peak is a traded day and sets the maximum in force later.
    One pass over the daily rows, each next to its entity's dates; a date without a row gives none."""
    dated = daily.join(summary.select(spec.entity, "peak_date", "trough_date"), spec.entity)
    at_peak, at_trough = (F.col(spec.date) == F.col(c) for c in ("peak_date", "trough_date"))
    found = dated.where(at_peak | at_trough).groupBy(spec.entity, "peak_date", "trough_date").agg(
        F.max(F.when(at_peak, F.col("volume_status"))).alias("peak_volume_status"),
        F.max(F.when(at_peak, F.col("adjclose"))).alias("peak_adjclose"),
        F.max(F.when(at_trough, F.col("running_peak"))).alias("running_peak_at_trough"),
    )
    return found.where("peak_volume_status IS NOT NULL AND running_peak_at_trough IS NOT NULL")


# ---------------------------------------------------------------- measures computed again from silver

#: Days that one bitmap of the aggregate functions holds, and what makes the number of any day positive.
BITMAP_DAYS, FIRST_DAY = 32_768, 1_000_000


def derived_base_date(silver: DataFrame) -> Column:
    """Scalar: the first date that is a normal day of every entity, null if there is none. Each entity's days are a set
    of bits, a few kilobytes; the sets are intersected by a partial aggregate, and what is left is opened."""
    n_entities = silver.select("ticker").distinct().agg(F.count("*")).scalar()
    number = F.unix_date("trade_date") + FIRST_DAY
    days = silver.filter(F.col("volume_status") == NORMAL).select(
        "ticker", F.bitmap_bucket_number(number).alias("part"), F.bitmap_bit_position(number).alias("bit")
    )
    sets = days.groupBy("ticker", "part").agg(F.bitmap_construct_agg("bit").alias("days"))
    common = sets.groupBy("part").agg(F.bitmap_and_agg("days").alias("days"), F.count("*").alias("n"))
    octet = F.conv(F.hex(F.substring("days", F.col("octet") + 1, F.lit(1))), 16, 10).cast("int")
    octets = common.filter(F.col("n") == n_entities).withColumn("octet", F.explode(F.sequence(F.lit(0), F.lit(BITMAP_DAYS // 8 - 1))))
    bits = octets.withColumn("bits", octet).filter("bits > 0").withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(7))))
    # Parts and their days are numbered from 1 on.
    day = (F.col("part") - 1) * BITMAP_DAYS + F.col("octet") * 8 + F.col("bit") + 1 - FIRST_DAY
    held = bits.filter(F.expr("getbit(bits, bit) = 1"))
    return held.agg(F.date_from_unix_date(F.min(day).cast("int"))).scalar()


def _beside(recomputed: DataFrame, published: DataFrame, measure: str) -> DataFrame:
    """Join on the entity: silver_<measure>, gold_<measure>, abs_diff."""
    ours, theirs = F.col(f"silver_{measure}"), F.col(f"gold_{measure}")
    return (
        recomputed.join(published.select("ticker", F.col(measure).alias(f"gold_{measure}")), "ticker")
        .withColumn("abs_diff", F.abs(ours - theirs))
        .orderBy("ticker")
    )


def _prices_in_order(bars: DataFrame) -> DataFrame:
    """(ticker, prices): each entity's adjusted closes as one list by date; a calendar bounds its length."""
    dated = F.array_sort(F.collect_list(F.struct("trade_date", "adjclose")))
    return bars.groupBy("ticker").agg(dated.getField("adjclose").alias("prices"))


def _steps(prices: Column) -> Column:
    """Each price over the one before it."""
    n = F.size(prices) - 1
    return F.zip_with(F.slice(prices, F.lit(2), n), F.slice(prices, F.lit(1), n), lambda later, earlier: later / earlier)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)


def total_return_check(silver: DataFrame, summary: DataFrame, base: datetime.date | Column | None = None) -> DataFrame:
    """The return of the whole period as the product of the steps from each bar to the next."""
    base = derived_base_date(silver) if base is None else base
    base = base if isinstance(base, Column) else F.lit(base)
    listed = _prices_in_order(silver.filter(F.col("trade_date") >= base))
    product = F.aggregate(_steps(F.col("prices")), F.lit(1.0), lambda total, step: total * step)
    again = listed.select("ticker", base.alias("base_date"), (product - 1).alias("silver_total_return"))
    return _beside(again, summary, "total_return").select(
        "ticker", "base_date", "silver_total_return", "gold_total_return", "abs_diff"
    )


def max_drawdown_check(silver: DataFrame, summary: DataFrame) -> DataFrame:
    """The deepest of an entity's drawdown episodes, each from a peak to the lowest price before the next one."""
    since = silver.filter(F.col("trade_date") >= derived_base_date(silver))
    deepest = drawdown_episodes(since).groupBy("ticker").agg(F.min("max_drawdown").alias("deepest"))
    again = since.select("ticker").distinct().join(deepest, "ticker", "left")
    return _beside(again.select("ticker", F.coalesce("deepest", F.lit(0.0)).alias("silver_max_drawdown")), summary, "max_drawdown")


def volatility_check(silver: DataFrame, summary: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """From the sums of the returns between normal bars and of their squares."""
    normal = silver.filter((F.col("trade_date") >= derived_base_date(silver)) & (F.col("volume_status") == NORMAL))
    returns = F.transform(_steps(F.col("prices")), lambda step: step - 1)
    sums = _prices_in_order(normal).withColumn("returns", returns).select(
        "ticker", F.size("returns").alias("n"), _total(F.col("returns")).alias("s"), _total(F.transform("returns", lambda r: r * r)).alias("q")
    )
    variance = (F.col("q") - F.col("s") * F.col("s") / F.col("n")) / (F.col("n") - 1)
    again = sums.select("ticker", F.when(F.col("n") > 1, F.sqrt(variance * spec.annualization)).alias("silver_vol_full_ann"))
    return _beside(again, summary, "vol_full_ann")


def _return_of_period(silver: DataFrame, ticker: str, period: Column, wanted: Column, before: datetime.date) -> DataFrame:
    """(ticker, return): the last price of the wanted period over that of the period before it, from the entity's period
    ends in order, latest first."""
    bars = silver.filter((F.col("ticker") == ticker) & (F.col("trade_date") < before))
    ends = bars.groupBy("ticker", period.alias("period")).agg(F.max_by("adjclose", "trade_date").alias("price"))
    listed = ends.groupBy("ticker").agg(F.sort_array(F.collect_list(F.struct("period", "price")), asc=False).alias("ends"))
    price = F.get("ends", F.lit(0)).getField("price") / F.get("ends", F.lit(1)).getField("price")
    return listed.filter(F.get("ends", F.lit(0)).getField("period") == wanted).select("ticker", (price - 1).alias("again"))


def yearly_return_check(silver: DataFrame, yearly: DataFrame, ticker: str, year: int) -> DataFrame:
    """One entity and year."""
    again = _return_of_period(silver, ticker, F.year("trade_date"), F.lit(year), datetime.date(year + 1, 1, 1))
    again = again.select("ticker", F.lit(year).alias("year"), F.col("again").alias("silver_yearly_return"))
    published = yearly.filter((F.col("ticker") == ticker) & (F.col("year") == year))
    return _beside(again, published, "yearly_return").select(
        "ticker", "year", "silver_yearly_return", "gold_yearly_return", "abs_diff"
    )


def monthly_return_check(silver: DataFrame, monthly: DataFrame, ticker: str, month_start: datetime.date) -> DataFrame:
    """One entity and month, the same way."""
    following = (month_start + datetime.timedelta(days=31)).replace(day=1)
    again = _return_of_period(silver, ticker, F.trunc("trade_date", "month"), F.lit(month_start), following)
    again = again.select("ticker", F.lit(month_start).alias("month_start"), F.col("again").alias("silver_monthly_return"))
    published = monthly.filter((F.col("ticker") == ticker) & (F.col("month_start") == F.lit(month_start)))
    return _beside(again, published, "monthly_return").select(
        "ticker", "month_start", "silver_monthly_return", "gold_monthly_return", "abs_diff"
    )


# ---------------------------------------------------------------- metadata


def commented_columns(columns: DataFrame) -> DataFrame:
    """Columns and commented columns per table, from ``column_metadata``."""
    return (
        columns.groupBy("table_name")
        .agg(F.count("*").alias("n_columns"), F.count("comment").alias("n_commented"))
        .orderBy("table_name")
    )


def comments_of(columns: DataFrame, table: str) -> DataFrame:
    return columns.filter(F.col("table_name") == table).orderBy("ordinal_position").select("column_name", "comment")
