import datetime
import json

import pytest
from pyspark.sql import functions as F

from barloom.plans import reconcile, serving
from barloom.plans.descriptions import GOLD_COMMENTS
from barloom.plans.refresh import refresh
from barloom.settings import Settings
from barloom.sources.catalog import append_audit, column_metadata, set_up, sql_literal, table_metadata
from barloom.sources.landing import folder_of, header_matches, summary_fields
from conftest import HEADER


def write(tmp_path, **changes):
    raw = {
        "catalog": "spark_catalog",
        "schemas": {layer: layer for layer in ("bronze", "silver", "gold", "ops")},
        "landing_path": "/landing",
        "tickers": [],
        "kpi": {"vol_window": 20, "rel_volume_window": 30, "annualization_factor": 250},
        **changes,
    }
    path = tmp_path / "settings.json"
    path.write_text(json.dumps(raw))
    return str(path)


def test_load(tmp_path):
    path = write(tmp_path)
    settings = Settings.load(path, "/w")
    assert (settings.panel.vol_window, settings.panel.rel_volume_window, settings.panel.annualization) == (20, 30, 250)
    assert settings.table("gold", "t") == "spark_catalog.gold.t" and settings.landed("x") == "/landing/x"
    changed = Settings.load(path, "/w", catalog=" other ", landing_path="/else/")
    assert changed.table("ops", "t") == "other.ops.t" and changed.landed("x") == "/else/x"
    assert Settings.load(path, "/w", catalog="  ").catalog == "spark_catalog"
    with pytest.raises(KeyError, match="platinum"):
        settings.table("platinum", "t")


@pytest.mark.parametrize("name", ["a b", "a;drop", "1a", "", "a.b", "a`"])
def test_names_must_be_plain(tmp_path, name):
    with pytest.raises(ValueError, match="plain"):
        Settings.load(write(tmp_path, catalog=name), "/w")


@pytest.mark.parametrize(
    ("line", "ok"),
    [
        (HEADER, True), ("\ufeff" + HEADER, True), (HEADER + "\r", True), (HEADER.replace("Date", "date"), False),
        (HEADER.replace("open,high", "high,open"), False), (HEADER + ",extra", False), ("", False), (None, False),
    ],
)
def test_header(spark, line, ok):
    frame = spark.createDataFrame([(line,)], "h STRING")
    assert frame.select(header_matches(F.col("h"), tuple(HEADER.split(",")))).first()[0] is ok


def test_summary_fields_keep_the_whole_document(spark):
    rows = [
        ('{"ticker": "A.X", "run_id": "R", "extra": {"b": 1, "a": [1, 2]}, "intervals": {"1d": {"rows": 5}}}', "f1"),
        ("not json", "f2"),
    ]
    good, bad = summary_fields(spark.createDataFrame(rows, "document STRING, source_file STRING")).collect()
    assert (good["source_symbol"], good["source_run_id"], good["daily_rows"], good["stock"]) == ("A.X", "R", 5, None)
    assert json.loads(good["raw_json"])["extra"] == {"b": 1, "a": [1, 2]}
    assert bad["source_symbol"] is None and bad["raw_json"] is None and bad["source_file"] == "f2"


def test_folder(spark):
    frame = spark.createDataFrame([("file:/x/landing/aa/A.X.csv",)], "p STRING")
    assert frame.select(folder_of(F.col("p"))).first()[0] == "aa"


@pytest.mark.parametrize("text", ["plain", "it's", "back\\slash", "\\' both", 'double "quotes"'])
def test_sql_literal_round_trip(spark, text):
    assert spark.sql(f"SELECT {sql_literal(text)}").first()[0] == text


def test_audit_rows(spark, settings):
    set_up(spark, settings)
    now = datetime.datetime(2026, 1, 1)
    append_audit(spark, settings, "r", "t", "FAILED", now, now, job_run_id="", error="e" * 5000)
    row = spark.table(settings.table("ops", "run_audit")).first()
    assert row["job_run_id"] is None and row["error_message"] == "e" * 5000
    with pytest.raises(ValueError, match="status"):
        append_audit(spark, settings, "r", "t", "DONE", now, now)


def test_published_queries(spark, settings):
    """One refresh, then the serving, validation and metadata queries on the catalog tables, as SQL users see them."""
    refresh(spark, settings, "run-1", "job-1")

    def gold(name):
        return spark.table(settings.table("gold", name))

    silver = spark.table(settings.table("silver", "daily_prices"))
    summary, daily = gold("ticker_summary"), gold("fact_daily_metrics")
    shown = serving.summary_dataset(summary, gold("dim_ticker")).collect()
    assert [(r["ticker"], r["short_name"], r["bank_name"]) for r in shown] == [
        ("A", "A", "A Holding"), ("B", "B", "B Holding"),
    ]
    labels = {r["year_label"] for r in serving.yearly_dataset(gold("fact_yearly_metrics")).collect()}
    assert labels == {"2020 (partial)"}
    matrix = serving.monthly_matrix(gold("fact_monthly_metrics"), ["A", "B"])
    assert matrix.columns == ["month_start", "is_partial", "A", "B"] and matrix.count() == 2
    dataset = serving.daily_dataset(daily)
    first, last = datetime.date(2020, 1, 3), datetime.date(2020, 1, 7)
    assert serving.in_range(serving.for_entities(dataset, ["A"]), first, last).count() == 3
    assert serving.for_entities(dataset, []).count() == 10
    for fixed in (serving.yearly_dataset(gold("fact_yearly_metrics")), summary):
        with pytest.raises(ValueError, match="does not apply"):
            serving.in_range(fixed, first, last)

    for check in (
        reconcile.total_return_check(silver, summary),
        reconcile.total_return_check(silver, summary, datetime.date(2020, 1, 2)),
        reconcile.max_drawdown_check(silver, summary),
        reconcile.volatility_check(silver, summary, settings.panel),
    ):
        assert [r["abs_diff"] < 1e-12 for r in check.collect()] == [True, True]
    peaks = reconcile.peak_and_trough_rows(summary, daily).collect()
    assert {r["peak_volume_status"] for r in peaks} == {"normal"}
    assert all(r["peak_adjclose"] == r["running_peak_at_trough"] for r in peaks)
    month = datetime.date(2020, 2, 1)
    row = reconcile.monthly_return_check(silver, gold("fact_monthly_metrics"), "B", month).first()
    assert row["abs_diff"] < 1e-12 and row["silver_monthly_return"] == pytest.approx(18 / 24 - 1)
    gaps = reconcile.null_vol_after_warmup(daily).collect()
    assert [(r["ticker"], r["volume_status"], r["null_vol_rows"]) for r in gaps] == []
    assert {r["leading_null_normal_rows"] for r in reconcile.leading_null_rows(daily, settings.panel).collect()} == {2}
    audit = spark.table(settings.table("ops", "run_audit"))
    assert [r["task_name"] for r in reconcile.audit_of_run(audit, "job-1").collect()] == [
        "bronze_ingest", "silver_transform", "gold_build",
    ]
    results = spark.table(settings.table("ops", "dq_results"))
    assert reconcile.latest_results(results, "silver", 14).count() == 14
    assert reconcile.results_of_run(results, "run-1").count() == 30

    tables = {r["table_name"]: r["comment"] for r in table_metadata(spark, settings, "gold").collect()}
    assert tables == {name: about for name, (about, _) in GOLD_COMMENTS.items()}
    columns = column_metadata(spark, settings, "gold")
    counts = {r["table_name"]: (r["n_columns"], r["n_commented"]) for r in reconcile.commented_columns(columns).collect()}
    assert counts == {
        "dim_ticker": (7, 5), "fact_daily_metrics": (18, 13), "fact_monthly_metrics": (11, 9),
        "fact_yearly_metrics": (9, 8), "ticker_summary": (13, 13),
    }
    listed = reconcile.comments_of(columns, "ticker_summary").collect()
    assert [r["column_name"] for r in listed][:2] == ["ticker", "total_return"] and all(r["comment"] for r in listed)

    sql = f"""
        SELECT ticker, COUNT_IF(volume_status = 'normal') AS normal FROM {settings.table("silver", "daily_prices")}
        GROUP BY ticker ORDER BY ticker"""
    assert [tuple(r) for r in spark.sql(sql).collect()] == [("A", 5), ("B", 4)]
