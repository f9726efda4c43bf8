import dataclasses
from pathlib import Path

import pytest

from barloom.plans.compare import overall, rerun_report
from barloom.plans.refresh import ChecksFailed, refresh, refresh_bronze, refresh_silver
from barloom.sources.catalog import OPS_TABLES, column_metadata, drop_all, set_up, table_metadata
from barloom.sources.landing import UnknownFolder, landing_report
from barloom.sources.store import SnapshotStore
from conftest import BARS, land

GOLD_SHAPE = {  # published columns, commented columns
    "dim_ticker": (7, 5),
    "fact_daily_metrics": (18, 13),
    "fact_monthly_metrics": (11, 9),
    "fact_yearly_metrics": (9, 8),
    "ticker_summary": (13, 13),
}


def test_refresh_publishes_every_layer_and_a_rerun_repeats_it(spark, settings):
    runs = refresh(spark, settings, "run-1")
    assert [(r.rows_in, r.rows_out, r.rows_rejected) for r in runs.values()] == [(12, 12, 0), (12, 12, 0), (12, 10, 0)]
    results = {r["check_name"]: r for run in runs.values() for r in run.results}
    assert len(results) == 30
    failing = {name for name, r in results.items() if not r["passed"]}
    assert failing == {"silver_zero_partial_count"}
    assert results["silver_zero_partial_count"]["failing_count"] == 1
    failures = spark.table(settings.table("ops", "check_failures")).where("pipeline_run_id = 'run-1'").collect()
    assert [(r["entity"], r["trade_date"]) for r in failures if r["check_name"] == "silver_zero_partial_count"] == [("B", "2020-01-06")]
    assert {r["value"] for r in failures if r["check_name"] == "gold_partial_periods"} == {"months=2 years=1"}
    assert results["silver_zero_all_tickers_count"]["failing_count"] == 2
    assert results["silver_base_date"]["details"] == "base_date=2020-01-02"
    assert results["gold_partial_periods"]["failing_count"] == 6

    summary = {r["ticker"]: r for r in spark.table(settings.table("gold", "ticker_summary")).collect()}
    assert summary["A"]["total_return"] == pytest.approx(0.0)
    assert summary["A"]["source_run_id"] == "R1" and summary["A"]["pipeline_run_id"] == "run-1"
    assert str(summary["B"]["peak_date"]) == "2020-01-07" and str(summary["B"]["trough_date"]) == "2020-02-03"
    for name, (n_columns, n_commented) in GOLD_SHAPE.items():
        columns = spark.catalog.listColumns(settings.table("gold", name))
        assert (len(columns), sum(c.description is not None for c in columns)) == (n_columns, n_commented)
    audit = spark.table(settings.table("ops", "run_audit")).orderBy("started_at").collect()
    assert [(a["task_name"], a["status"]) for a in audit] == [
        ("bronze_ingest", "SUCCEEDED"), ("silver_transform", "SUCCEEDED"), ("gold_build", "SUCCEEDED"),
    ]

    first = rerun_report(spark, settings)
    assert {r["result"] for r in first.collect()} == {"SKIPPED"} and overall(first) == "FAIL"
    refresh(spark, settings, "run-2")
    report = rerun_report(spark, settings)
    assert overall(report) == "PASS" and report.count() == 9
    store = SnapshotStore(spark, settings)
    old = store.read("gold", "ticker_summary", version=0)
    assert {r["pipeline_run_id"] for r in old.collect()} == {"run-1"}
    assert {r["pipeline_run_id"] for r in store.read("gold", "ticker_summary").collect()} == {"run-2"}

    spark.sql(f"DROP TABLE {settings.table('gold', 'ticker_summary')}")
    store.sync()
    assert spark.table(settings.table("gold", "ticker_summary")).count() == 2


def test_duplicate_key_keeps_the_last_good_run_until_recovery_and_reset_empties_all(spark, settings, tmp_path):
    refresh(spark, settings, "good")
    broken = {t: list(rows) for t, rows in BARS.items()}
    broken["A"][3] = broken["A"][2]
    bad = dataclasses.replace(settings, landing_path=land(tmp_path / "broken", broken, run_id="R2"))
    with pytest.raises(ChecksFailed, match="silver_no_duplicate_keys"):
        refresh(spark, bad, "bad")
    store = SnapshotStore(spark, settings)
    for layer, name, run in (
        ("bronze", "daily_prices_raw", "bad"), ("silver", "daily_prices", "good"), ("gold", "ticker_summary", "good"),
    ):
        assert {r[0] for r in store.read(layer, name).select("pipeline_run_id").distinct().collect()} == {run}
        table = spark.table(settings.table(layer, name))
        assert {r[0] for r in table.select("pipeline_run_id").distinct().collect()} == {run}
    audit = {
        (a["pipeline_run_id"], a["task_name"]): a for a in spark.table(settings.table("ops", "run_audit")).collect()
    }
    assert audit["bad", "silver_transform"]["status"] == "FAILED"
    assert "silver_no_duplicate_keys" in audit["bad", "silver_transform"]["error_message"]
    assert ("bad", "gold_build") not in audit
    dq = {r["check_name"]: r for r in spark.table(settings.table("ops", "dq_results")).filter(
        "pipeline_run_id = 'bad'").collect()}
    assert dq["silver_no_duplicate_keys"]["failing_count"] == 1
    assert not dq["silver_same_date_set"]["passed"] and all(not n.startswith("gold") for n in dq)
    refresh(spark, settings, "recovered")
    assert {r[0] for r in spark.table(settings.table("gold", "ticker_summary")).select("pipeline_run_id").collect()} == {
        "recovered"
    }

    for word in (None, "", "reset", "RESET!"):
        with pytest.raises(PermissionError):
            drop_all(spark, settings, word)
    dropped, absent = drop_all(spark, settings, " RESET ")
    assert len(dropped) == 13 and not absent
    set_up(spark, settings)
    assert spark.table(settings.table("ops", "run_audit")).isEmpty()
    refresh_bronze(spark, settings, "after reset")
    assert len(SnapshotStore(spark, settings).latest_two("bronze", "daily_prices_raw")) == 1


@pytest.mark.parametrize(
    ("change", "check"),
    [
        ({"declared": 99}, "bronze_rows_match_run_summary"),
        ({"symbol": "Z"}, "bronze_source_symbol_matches"),
        ({"header": "date,open,high,low,close,adjclose,volume,ingested_at_utc"}, "bronze_header_matches"),
    ],
)
def test_bronze_stops_on(spark, settings, tmp_path, change, check):
    bad = dataclasses.replace(settings, landing_path=land(tmp_path / "bad", **change))
    with pytest.raises(ChecksFailed, match=check):
        refresh(spark, bad, "bad")
    assert not spark.catalog.tableExists(settings.table("bronze", "daily_prices_raw"))


def test_missing_entity_and_unknown_folder(spark, settings, tmp_path):
    one = dataclasses.replace(settings, landing_path=land(tmp_path / "one", {"A": BARS["A"]}))
    with pytest.raises(ChecksFailed, match="bronze_all_tickers_present"):
        refresh(spark, one, "bad")
    extra = dataclasses.replace(settings, landing_path=land(tmp_path / "extra", {**BARS, "C": BARS["A"]}))
    with pytest.raises(UnknownFolder, match="'c'"):
        refresh(spark, extra, "bad")


def test_quarantine_keeps_source_text_and_odd_lines_are_rescued(spark, settings, tmp_path):
    rows = {t: list(r) for t, r in BARS.items()}
    rows["A"][4] = ("2020-01-07", "abc", "12", "10", "10", "0", "-5")
    root = Path(land(tmp_path / "dirty", rows))
    path = root / "b" / "B.X.csv"
    lines = path.read_text().splitlines()
    lines[2] += ",extra"
    path.write_text("\n".join(lines) + "\n")
    dirty = dataclasses.replace(settings, landing_path=str(root))
    set_up(spark, dirty)
    bronze = refresh_bronze(spark, dirty, "dirty")
    assert {r["check_name"]: r["failing_count"] for r in bronze.results}["bronze_rescued_data_empty"] == 1
    silver = refresh_silver(spark, dirty, "dirty")
    assert (silver.rows_out, silver.rows_rejected) == (10, 2)
    rejected = {r["ticker"]: r for r in spark.table(dirty.table("silver", "daily_prices_quarantine")).collect()}
    assert rejected["A"]["open"] == "abc" and rejected["A"]["bronze_pipeline_run_id"] == "dirty"
    assert rejected["A"]["reject_reason"] == "invalid_price;non_positive_price;invalid_volume"
    assert rejected["B"]["reject_reason"] == "rescued_data_present" and rejected["B"]["_rescued_data"] == '{"8":"extra"}'


def test_landing_report(spark, settings, tmp_path):
    report = {r["ticker"]: r for r in landing_report(spark, settings).collect()}
    assert all(r["row_ok"] and r["csv_rows"] == 6 for r in report.values()) and len(report) == 2
    assert report["A"]["date_min"] == "2020-01-01" and report["A"]["source_run_id"] == "R1"
    one = dataclasses.replace(settings, landing_path=land(tmp_path / "one", {"A": BARS["A"]}, declared=7))
    report = {r["ticker"]: r for r in landing_report(spark, one).collect()}
    assert report["A"]["csv_exists"] and not report["A"]["rows_match"] and not report["A"]["row_ok"]
    assert not report["B"]["csv_exists"] and not report["B"]["json_exists"] and not report["B"]["row_ok"]


def test_landed_files_are_listed_once_for_each_reader(spark, settings, monkeypatch):
    from barloom.sources import landing

    listed = []
    scan = landing.scan
    monkeypatch.setattr(landing, "scan", lambda spark, glob, kind, *rest, **more: listed.append(kind) or scan(spark, glob, kind, *rest, **more))
    set_up(spark, settings)
    refresh_bronze(spark, settings, "counted")
    assert sorted(listed) == ["binaryFile", "csv", "text", "text"]


def test_scan_takes_the_files_a_glob_names(spark, tmp_path):
    from barloom.sources.landing import landed_files

    for name in ("a/x.csv", "a/x.txt", "a/b/y.csv", "b c+%/z.csv", "top.csv", "a1/q.csv", "_hidden/h.csv"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("1\n")
    cases = {
        "*/*.csv": {"a/x.csv", "b c+%/z.csv", "a1/q.csv"}, "*.csv": {"top.csv"}, "a/*": {"a/x.csv", "a/x.txt"}, "*/*/*.csv": {"a/b/y.csv"},
        "a?/*.csv": {"a1/q.csv"}, "{a,a1}/[xq].csv": {"a/x.csv", "a1/q.csv"}, "a[!0-9]/*.csv": set(), "a/x.csv": {"a/x.csv"},
    }
    for glob, want in cases.items():
        for root in (str(tmp_path), f"file://{tmp_path}", f"{tmp_path}/"):
            found = {r["source_file"].split(f"{tmp_path}/")[1] for r in landed_files(spark, f"{root}/{glob}").collect()}
            assert found == want, (glob, found)


def test_temporary_views_are_no_tables_of_a_schema(spark, settings):
    set_up(spark, settings)
    spark.range(1).createOrReplaceTempView("a_view_of_the_session")
    try:
        assert {r["table_name"] for r in table_metadata(spark, settings, "ops").collect()} == set(OPS_TABLES)
        assert {r["table_name"] for r in column_metadata(spark, settings, "ops").collect()} == set(OPS_TABLES)
    finally:
        spark.catalog.dropTempView("a_view_of_the_session")
