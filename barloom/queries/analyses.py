"""Registered queries: performance of any range, drawdown episodes, coarse bars against daily ones, rescued fields and
the drift of run summaries."""

from __future__ import annotations

import dataclasses
import datetime
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.alerts import level_alerts
from barloom.operators.checksums import bucket_checksums, two_stage_diff
from barloom.operators.diff import verdict
from barloom.operators.episodes import drawdown_episodes
from barloom.operators.history import as_of, fold_versions, restated_per_version, restatements
from barloom.operators.labels import month_after, reconcile_bars, week_after
from barloom.operators.performance import register_window_performance, store_blocks, window_performance
from barloom.plans import serving
from barloom.plans.compare import rerun_report, store_checksums
from barloom.plans.layout import store_for_serving
from barloom.queries.landed import published, recovered
from barloom.queries.layers import Layers, series_layers, supplier_layers
from barloom.queries.registry import diff_cases, query, rounded
from barloom.session import local_rows, shared_folder, stored
from barloom.settings import LAYERS, SOURCE_COLUMNS
from barloom.sources.bars import supplier_panel
from barloom.sources.catalog import RESET_WORD, append_failures, drop_all, set_up, tables_of
from barloom.sources.drift import document_drift, document_paths, landed_documents
from barloom.sources.landing import folder_of, read_lines

#: Ranges that are asked for: all days, whole years, parts of blocks, one block, a range that begins on a day without
#: trade in every series, single days, nothing.
RANGES = {
    "all": ("1990-01-01", "2000-12-31"),
    "one year": ("1995-01-01", "1995-12-31"),
    "odd days": ("1993-02-17", "1997-11-05"),
    "two weeks": ("1996-03-04", "1996-03-17"),
    "across one border": ("1994-06-20", "1994-07-25"),
    "one day": ("1994-06-20", "1994-06-20"),
    "turned": ("1995-02-01", "1995-01-01"),
    "before all": ("1980-01-01", "1981-01-01"),
}


def _performance(spark: SparkSession, layers: Layers) -> DataFrame:
    folder, name = shared_folder(spark), "window_performance"
    store_blocks(layers.silver, folder, layers.spec)
    register_window_performance(spark, folder, name, layers.spec)
    each = [
        window_performance(spark, datetime.date.fromisoformat(a), datetime.date.fromisoformat(b), name).withColumn("asked", F.lit(label))
        for label, (a, b) in RANGES.items()
    ]
    return rounded(reduce(DataFrame.unionByName, each), "total_return", "vol_ann", "max_drawdown", "current_drawdown")


@query
def window_performance_ranges(spark, sf_dir):
    """Return, volatility and deepest drawdown of the long series in ranges of dates, by the SQL table function."""
    return _performance(spark, series_layers(spark, sf_dir))


@query
def supplier_window_performance(spark, sf_dir):
    """The same over a series per supplier: some have a single bar in a range, many have none."""
    return _performance(spark, supplier_layers(spark, sf_dir))


@query
def drawdown_episode_list(spark, sf_dir):
    return rounded(drawdown_episodes(series_layers(spark, sf_dir).silver), "max_drawdown")


@query
def supplier_drawdown_episodes(spark, sf_dir):
    return rounded(drawdown_episodes(supplier_layers(spark, sf_dir).silver), "max_drawdown")


def coarse_bars(daily: DataFrame, label: Column) -> DataFrame:
    """Bars per ``label`` with a source's faults: of labels numbered by their day, every 5th is absent, every 7th has
    another close, every 11th another high and volume, every 13th no open, and every 17th stands for a period without days
    (it is moved by 20,000 days)."""
    bars = daily.groupBy("ticker", label.alias("label")).agg(
        F.min_by("open", "trade_date").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "trade_date").alias("close"),
        F.sum("volume").alias("volume"),
    )
    n = F.expr("unix_date(label) + length(ticker) + ascii(ticker)")

    def every(k: int) -> Column:
        return n % k == 0

    return bars.where(~every(5)).select(
        "ticker",
        F.when(every(17), F.date_add("label", 20_000)).otherwise(F.col("label")).alias("label"),
        F.when(~every(13), F.col("open")).alias("open"),
        (F.col("high") + F.when(every(11), 0.5).otherwise(0.0)).alias("high"),
        "low",
        (F.col("close") + F.when(every(7), 0.01).otherwise(0.0)).alias("close"),
        (F.col("volume") + every(11).cast("bigint")).alias("volume"),
    )


def _monday_before(day: str) -> Column:
    """The Monday whose seven following days hold the day."""
    return F.trunc(F.date_sub(day, 1), "week").cast("date")


@query
def weekly_bar_differences(spark, sf_dir):
    """Weekly bars, labelled with the Monday before their days, against the daily ones, per supplier."""
    daily = stored(supplier_panel(spark, sf_dir))
    return reconcile_bars(daily, coarse_bars(daily, _monday_before("trade_date")), week_after, 7)


@query
def monthly_bar_differences(spark, sf_dir):
    """Monthly bars, labelled with the last day of the month before, against the daily ones, per supplier."""
    daily = stored(supplier_panel(spark, sf_dir))
    label = F.date_sub(F.trunc("trade_date", "month"), 1)
    return reconcile_bars(daily, coarse_bars(daily, label), month_after, 32)


def landed_event_lines(events: DataFrame, folder: str) -> None:
    """Events as CSV lines of eight columns, a folder per kind of event. Of nine ids, one each gives a field too many,
    two too few, a quoted field with a comma that fits, one that does not and an empty one behind it, three too many,
    seven too few, and a quoted one with quotes in it."""
    number = F.col("event_id").cast("string")
    fitting = [number, *[F.lit(str(v)) for v in (10, 12, 9, 11, 10.5)]]

    def line(*fields) -> Column:
        return F.concat_ws(",", *[F.lit(f) if isinstance(f, str) else f for f in fields])

    user, stamp, n = F.col("user_id").cast("string"), "noon", F.col("event_id") % 9
    text = (
        F.when(n == 1, line(*fitting, user, stamp, F.concat(F.lit("x"), number)))
        .when(n == 2, line(*fitting))
        .when(n == 3, line(*fitting, F.concat(F.lit('"'), user, F.lit(',5"')), stamp))
        .when(n == 4, line(*fitting, user, stamp, F.concat(F.lit('"a,'), number, F.lit('"')), ""))
        .when(n == 5, line(*fitting, user, stamp, "p", "q", "r"))
        .when(n == 6, line(number))
        .when(n == 7, line(*fitting, user, stamp, F.concat(F.lit('"say \\"hi\\" '), number, F.lit('"'))))
        .otherwise(line(*fitting, user, stamp))
    )
    # One column whose name is the header line, written as it is.
    lines = events.select(text.alias(",".join(SOURCE_COLUMNS)), F.col("event_type").alias("folder"))
    lines.write.partitionBy("folder").options(header=True, sep="\u0001", quote="", escapeQuotes=False).csv(folder)


@query
def rescued_fields(spark, sf_dir):
    """Landed lines of every shape: the fields that fit, and the places and texts of those that do not."""
    folder = shared_folder(spark)
    landed_event_lines(spark.read.parquet(f"{sf_dir}/events.parquet"), folder)
    lines = read_lines(spark, f"{folder}/*/*.csv", SOURCE_COLUMNS)
    return lines.select(
        F.col(SOURCE_COLUMNS[0]).alias("event"), "open", "adjclose", "volume", "ingested_at_utc", "_rescued_data", folder_of(F.col("source_file")).alias("folder")
    )


def landed_supplier_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run summary per supplier, landed and read. Numbers of suppliers divisible by 3 have a field too many, by 5 no
    run id, by 7 a count as text, by 11 a null interval, by 13 text instead of the intervals, by 17 no JSON at all."""
    counted = supplier_panel(spark, sf_dir).groupBy("ticker").agg(F.count("*").alias("n"), F.max("trade_date").alias("last"))
    number = F.col("ticker").cast("bigint")

    def every(k: int, text, otherwise) -> Column:
        return F.when(number % k == 0, text).otherwise(otherwise)

    n = F.col("n").cast("string")
    rows = every(7, F.concat(F.lit('"'), n, F.lit('"')), n)
    last = F.concat(F.lit('{"date_max":"'), F.date_format("last", "yyyy-MM-dd"), F.lit('","duplicate_dates":0,"rows":'))
    daily, weekly = F.concat(last, rows, F.lit("}")), every(11, "null", F.concat(last, n, F.lit("}")))
    monthly = F.concat(last, n, F.lit("}"))
    intervals = F.concat(F.lit('{"1d":'), daily, F.lit(',"1wk":'), weekly, F.lit(',"1mo":'), monthly, F.lit("}"))
    text = F.concat(
        F.lit('{"ticker":"'), F.col("ticker"), F.lit('","stock":"S","intervals":'),
        every(13, '"none"', intervals), every(5, "", ',"run_id":"r"'),
        every(3, F.concat(F.lit(',"vendor":{"name":"v'), F.col("ticker"), F.lit('","ids":[1,"x"]}')), ""), F.lit("}"),
    )
    folder = shared_folder(spark)
    every_text = every(17, "not json {", text).alias("value")
    counted.select(every_text, F.col("ticker").alias("folder")).repartition("folder").write.partitionBy("folder").text(folder)
    return landed_documents(spark, f"{folder}/*/*.txt").withColumn("source_file", F.substring_index(folder_of(F.col("source_file")), "=", -1))


@query
def summary_drift(spark, sf_dir):
    """Per supplier's run summary: fields that are added, missing or of another type, and texts that are no JSON."""
    drift = document_drift(landed_supplier_documents(spark, sf_dir))
    return drift.withColumnRenamed("source_file", "ticker")


@query
def summary_structure(spark, sf_dir):
    """Every path of the landed run summaries, with its types and how many documents have it so."""
    paths = document_paths(landed_supplier_documents(spark, sf_dir))
    return paths.groupBy("path", "kind").agg(F.count("*").alias("n_documents"))


BAR_KEY = ["ticker", "trade_date"]


def supplier_versions(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Supplier bars as they were published five times: up to 1997, then all with the prices of 1995 restated, the same
    again, without the volumes above 45 and with the bars of supplier 1 doubled, and as the second time."""
    bars = stored(supplier_panel(spark, sf_dir).select(*BAR_KEY, "close", "adjclose", "volume"))
    in_1995 = F.year("trade_date") == 1995
    second = bars.withColumn("adjclose", F.when(in_1995, F.col("adjclose") + 0.25).otherwise(F.col("adjclose")))
    thin = second.where("volume <= 45")
    return [bars.where("trade_date < '1998-01-01'"), second, second, thin.unionByName(thin.where("ticker = '1'")), second]


@query
def snapshot_history(spark, sf_dir):
    """Five versions folded into rows with the versions they held in."""
    return fold_versions(supplier_versions(spark, sf_dir))


@query
def snapshot_as_of(spark, sf_dir):
    """The fourth version, rebuilt from the history, doubled rows included."""
    return as_of(fold_versions(supplier_versions(spark, sf_dir)), 3)


@query
def restated_keys(spark, sf_dir):
    """Keys on which the first and the fourth version do not agree, and in which columns."""
    return restatements(fold_versions(supplier_versions(spark, sf_dir)), BAR_KEY, 0, 3)


@query
def restatements_per_version(spark, sf_dir):
    return restated_per_version(fold_versions(supplier_versions(spark, sf_dir)), BAR_KEY, 5)


@query
def two_stage_diff_cases(spark, sf_dir):
    """The cases of ``snapshot_diff_cases``, from the checksums of both sides and the rows of the buckets that differ."""
    panel, cases = diff_cases(spark, sf_dir)
    before = stored(bucket_checksums(panel, BAR_KEY))
    out = []
    for label, changed in cases.items():
        diff = two_stage_diff(panel, changed, before, bucket_checksums(changed, BAR_KEY, known=before), BAR_KEY)
        widest = F.when(F.col("max_double_diff") > 1e300, -1.0).otherwise(F.round("max_double_diff", 6))
        out.append(
            diff.select(
                F.lit(label).alias("case_name"), "rows_prev", "rows_latest", "dup_keys", "missing_rows", "mismatched_non_double",
                widest.alias("max_diff"), verdict().alias("result"),
            )
        )
    return reduce(DataFrame.unionByName, out)


@query
def exact_rerun_report(spark, sf_dir):
    """The report after the recovery without any tolerance, equal buckets told by their checksums alone."""
    settings = recovered(spark, sf_dir).settings
    store_checksums(spark, settings)
    report = rerun_report(spark, settings, tolerance=0.0, checksums=True)
    return report.drop("note").withColumn("table", F.regexp_replace("table", r"^spark_catalog\.([a-z]+)_[0-9a-f]+\.", "$1."))


@query
def check_level_alerts(spark, sf_dir):
    """Days as runs and kinds of events as checks: how many events a day have a volume that is rejected, a third more (50
    at least) of purchases from the 20th on; where the level changes."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_type").alias("check_name"), F.to_date("ts").alias("checked_at"), "event_id")
    counts = events.groupBy("check_name", "checked_at").agg(F.count_if(F.col("event_id") % 7 == 0).alias("n"))
    shifted = (F.col("check_name") == "purchase") & (F.dayofmonth("checked_at") >= 20)
    more = F.greatest(F.floor(F.col("n") / 3), F.lit(50))
    history = counts.withColumn("failing_count", F.col("n") + F.when(shifted, more).otherwise(0))
    return rounded(level_alerts(history), "level", "spread", "up", "down")


@query
def bucketed_daily_dataset(spark, sf_dir):
    """Daily rows of all series with the entity's name, from tables that are bucketed for the join."""
    layers, schema = series_layers(spark, sf_dir), f"serving_{uuid.uuid4().hex[:8]}"
    folder = shared_folder(spark)
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{folder}'")
    tables = store_for_serving(spark, {"fact_daily_metrics": layers.fact, "dim_ticker": layers.dim()}, schema, folder, 8)
    named = serving.daily_dataset(tables["fact_daily_metrics"]).join(tables["dim_ticker"].select("ticker", "short_name"), "ticker")
    return rounded(named, "normalized_index", "daily_return", "vol_60d_ann", "drawdown", "rel_volume_60d")


@query
def set_up_and_reset(spark, sf_dir):
    """A workspace set up, filled with a failing item per supplier, set up again, dropped with a wrong and with the right
    word, and set up once more: its history tables and their rows after each step."""
    root, tag = shared_folder(spark), uuid.uuid4().hex[:8]
    settings = dataclasses.replace(
        published(spark, sf_dir).settings, warehouse=f"{root}/warehouse", schemas={layer: f"{layer}_{tag}" for layer in LAYERS}
    )
    item = {"check_name": "c", "layer": "l", "entity": "s_suppkey", "trade_date": "t", "value": "v"}
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    items = suppliers.select(*[(F.col(v).cast("string") if v == "s_suppkey" else F.lit(v)).alias(c) for c, v in item.items()])

    def reset(word: str) -> None:
        try:
            drop_all(spark, settings, word)
        except PermissionError:
            pass

    steps = {
        "set up": lambda: set_up(spark, settings),
        "filled": lambda: append_failures(spark, settings, items, "run"),
        "set up again": lambda: set_up(spark, settings),
        "wrong word": lambda: reset("yes"),
        "right word": lambda: reset(RESET_WORD),
        "set up at last": lambda: set_up(spark, settings),
    }
    counts = []
    for place, (name, step) in enumerate(steps.items()):
        step()
        schema = settings.table("ops", "").rstrip(".")
        tables = [t.name for t in tables_of(spark, schema)]
        rows = sum(spark.table(settings.table("ops", t)).count() for t in tables)
        counts.append((place, name, len(tables), rows))
    return local_rows(spark, counts, "place int, step string, n_tables bigint, n_rows bigint")
