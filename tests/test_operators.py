"""Each operator against plain code over random panels, and on panels made for one rule. Windows are 3 rows and the factor 252."""

import dataclasses
import datetime
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from barloom.operators.daily import daily_metrics
from barloom.operators.diff import METRICS_SCHEMA, snapshot_diff, unmatched_keys, verdict
from barloom.operators.flags import adjclose_not_carried, base_date_value, entity_profile, volume_status, zero_volume_not_flat
from barloom.operators.layer_checks import daily_profile
from barloom.operators.inject import replace_row_with_previous
from barloom.operators.periods import monthly_metrics, yearly_metrics
from barloom.operators.quality import Check, evaluate
from barloom.operators.series import SeriesSplit
from barloom.operators.summary import summary_metrics
from barloom.operators.validate import duplicate_keys, reason_histogram, reject_reasons, split_rows, type_bars
from barloom.session import local_rows
from barloom.spec import PRICE_COLUMNS, REJECT_CODES, PanelSpec

SPEC = PanelSpec(vol_window=3, rel_volume_window=3)
DAILY = "ticker STRING, trade_date DATE, close DOUBLE, adjclose DOUBLE, volume BIGINT, volume_status STRING"


def day(text):
    return datetime.date.fromisoformat(f"2020-{text}")


def near(value):
    return None if value is None else pytest.approx(value, abs=1e-12)


# ---------------------------------------------------------------- random panels and what plain code makes of them

STATUS = ("normal", "zero_partial", "zero_all_tickers")


def weekdays(first, n):
    days = (first + datetime.timedelta(days=i) for i in range(2 * n + 10))
    return [d for d in days if d.weekday() < 5][:n]


def walk(seed, n, first=datetime.date(2023, 11, 16)):
    """A price walk over weekdays in quarter steps, so that peaks are touched again; every few rows without trade."""
    rng = random.Random(seed)
    rows, price = [], 40.0
    for d in weekdays(first, n):
        idle = rows and rng.random() < 0.2
        price = price if idle else max(5.0, price + rng.choice((-1.5, -0.75, -0.25, 0.0, 0.25, 0.75, 1.5)))
        rows.append((d, price, 0 if idle else rng.randrange(1, 90), "zero_partial" if idle else "normal"))
    return rows


def panel(spark, series):
    rows = [(name, d, p, p, v, s) for name, bars in series.items() for d, p, v, s in bars]
    return spark.createDataFrame(rows, DAILY)


def plain_daily(bars, window=3):
    """Measures of one series by going through its rows."""
    out, traded, top = {}, [], None
    for d, p, v, s in bars:
        top = (p, d) if top is None or p > top[0] else top
        row = {"index": 100 * p / bars[0][1], "peak": top[0], "drawdown": p / top[0] - 1, "ret": None, "vol": None, "rel": None, "peak_day": top[1]}
        if s == "normal":
            row["ret"] = p / traded[-1][0] - 1 if traded else None
            if len(traded) >= window:
                row["rel"] = v / statistics.mean(w for _, w, _ in traded[-window:])
            traded.append((p, v, row["ret"]))
            last = [r for _, _, r in traded[-window:]]
            if len(last) == window and None not in last:
                row["vol"] = statistics.stdev(last) * math.sqrt(252)
        out[d] = row
    return out


# ---------------------------------------------------------------- flags


def test_volume_status_and_base_date(spark):
    rng = random.Random(11)
    dates = weekdays(datetime.date(2024, 5, 6), 15)
    volumes = {(t, d): 0 if i in (0, 7) or (i < 4 or rng.random() < 0.3) and t != "K" else rng.randrange(1, 9)
               for i, d in enumerate(dates) for t in "KLM"}
    rows = [(t, d, v) for (t, d), v in volumes.items()]
    flagged = volume_status(spark.createDataFrame(rows, "ticker STRING, trade_date DATE, volume BIGINT"))
    traded = {d: sum(volumes[t, d] > 0 for t in "KLM") for d in dates}
    want = {(t, d): "normal" if v else STATUS[2] if not traded[d] else STATUS[1] for (t, d), v in volumes.items()}
    assert {(r["ticker"], r["trade_date"]): r["volume_status"] for r in flagged.collect()} == want
    for n, coverage in ((3, 1.0), (2, 1.0), (3, 0.3), (4, 1.0)):
        first = min((d for d in dates if traded[d] >= math.ceil(n * coverage)), default=None)
        assert base_date_value(flagged, n, PanelSpec(min_coverage=coverage)) == first


PRICED = "ticker STRING, trade_date DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, adjclose DOUBLE, volume BIGINT"


@pytest.mark.parametrize("split", [None, SeriesSplit(block_days=2)])
def test_rows_without_volume(spark, split):
    rows = [
        ("A", day("01-01"), 10.0, 10.0, 10.0, 10.0, 9.0, 0),  # first row: flat is enough
        ("A", day("01-02"), 10.0, 12.0, 9.0, 11.0, 9.9, 5),
        ("A", day("01-03"), 11.0, 11.0, 11.0, 11.0 + 1e-7, 9.9, 0),  # within tolerance
        ("A", day("01-06"), 11.0, 11.5, 11.0, 11.0, 9.9, 0),  # not flat
        ("A", day("01-07"), 12.0, 12.0, 12.0, 12.0, 9.8, 0),  # flat at another price, adjclose not carried
        ("B", day("01-07"), 50.0, 50.0, 50.0, 50.0, 50.0, 0),
    ]
    bars = spark.createDataFrame(rows, PRICED)
    assert {r["trade_date"] for r in zero_volume_not_flat(bars, split=split).collect()} == {day("01-06"), day("01-07")}
    moved = adjclose_not_carried(bars, split=split).collect()
    assert [(r["trade_date"], r["prev_adjclose"]) for r in moved] == [(day("01-07"), 9.9)]


def test_copies_of_a_key_keep_their_rows_in_the_zero_volume_check(spark):
    rows = [("A", day("01-02"), 10.0, 10.0, 10.0, 10.0, 10.0, 5)] + [
        ("A", day("01-03"), 11.0, 11.0, 11.0, 11.0, 11.0, 0)
    ] * 50
    assert zero_volume_not_flat(spark.createDataFrame(rows, PRICED)).count() == 50


# ---------------------------------------------------------------- validation

RAW = (
    "name STRING, source_date STRING, open STRING, high STRING, low STRING, close STRING, adjclose STRING, "
    "volume STRING, ingested_at_utc STRING, _rescued_data STRING"
)
COLUMNS = ("source_date", *PRICE_COLUMNS, "volume", "ingested_at_utc", "_rescued_data")
SOUND = ("2021-06-30", "73.5", "75", "70.25", "71", "68.125", "4200", "2026-01-02 03:04:05.000006+00:00", None)
SPOILED = {
    "source_date": [("2021-02-30", "invalid_date"), ("soon", "invalid_date"), (None, "invalid_date")],
    "open": [("", "invalid_price"), ("NaN", "invalid_price"), (None, "invalid_price"), ("-1", "non_positive_price")],
    "high": [("Infinity", "invalid_price"), ("72", "ohlc_inconsistent")],
    "low": [("74", "ohlc_inconsistent"), ("0", "non_positive_price")],
    "adjclose": [("0.0", "non_positive_price"), ("1e", "invalid_price")],
    "volume": [("-1", "invalid_volume"), ("2.5", "invalid_volume"), ("many", "invalid_volume"), ("0", None)],
    "ingested_at_utc": [("yesterday", None)],
    "_rescued_data": [("a,b", "rescued_data_present")],
}


@pytest.fixture(scope="module")
def judged(spark):
    """Each fault alone, and random sets of them; with the codes that the faults stand for. A price that cannot be read cannot be inconsistent."""
    rng = random.Random(5)
    faults = [(c, *f) for c, fs in SPOILED.items() for f in fs]
    sets = [[], *[[f] for f in faults], *[rng.sample(faults, rng.randrange(2, 6)) for _ in range(60)]]
    rows, want = [], {}
    for n, chosen in enumerate(sets):
        by_column = {c: (value, code) for c, value, code in chosen}
        rows.append((str(n), *[by_column[c][0] if c in by_column else sound for c, sound in zip(COLUMNS, SOUND, strict=True)]))
        codes = {code for _, code in by_column.values()}
        unread = {c for c, (_, code) in by_column.items() if code == "invalid_price"}
        values = {c: float(rows[-1][2 + i]) for i, c in enumerate(PRICE_COLUMNS) if c not in unread}
        body = [values[c] for c in ("open", "close") if c in values]
        codes.discard("ohlc_inconsistent")
        if body and ("low" in values and values["low"] > min(body) or "high" in values and values["high"] < max(body)):
            codes.add("ohlc_inconsistent")
        want[str(n)] = [code for code in REJECT_CODES if code in codes]
    return reject_reasons(type_bars(spark.createDataFrame(rows, RAW))), want


def test_reject_reasons(judged):
    got = {r["name"]: (list(r["reject_reasons"]), r["reject_reason"]) for r in judged[0].collect()}
    assert got == {name: (codes, ";".join(codes)) for name, codes in judged[1].items()}


def test_typed_values_stand_beside_the_text(judged):
    row = judged[0].filter("name = '0'").first()
    assert (row["low"], row["typed"]["low"], row["typed"]["volume"]) == ("70.25", 70.25, 4200)
    assert row["typed"]["source_ingested_at"] is not None and row["typed"]["trade_date"] == datetime.date(2021, 6, 30)


def test_split_is_complete_and_histogram_counts_codes(judged):
    valid, rejected = split_rows(judged[0])
    assert {r["name"] for r in valid.collect()} == {name for name, codes in judged[1].items() if not codes}
    assert rejected.count() == sum(map(bool, judged[1].values()))
    listed = [code for codes in judged[1].values() for code in codes]
    assert {r["reason"]: r["n_rows"] for r in reason_histogram(rejected).collect()} == {c: listed.count(c) for c in listed}


def test_duplicate_keys(spark):
    held = {(1, "x"): 3, (1, "y"): 1, (2, "x"): 2, (None, "x"): 2}
    frame = spark.createDataFrame([key for key, n in held.items() for _ in range(n)], "a INT, b STRING")
    assert {(r["a"], r["b"]): r["count"] for r in duplicate_keys(frame, "a", "b").collect()} == {k: n for k, n in held.items() if n > 1}


# ---------------------------------------------------------------- daily and summary

SERIES = {"P": walk(1, 45), "Q": walk(2, 45), "R": walk(3, 4)}
BASE = SERIES["P"][0][0]
SPLITS = [None, SeriesSplit(block_days=9, chunk_rows=4)]


@pytest.mark.parametrize("split", SPLITS)
def test_daily_measures(spark, split):
    found = daily_metrics(panel(spark, SERIES), BASE, SPEC, split).collect()
    want = {(t, d): m for t, bars in SERIES.items() for d, m in plain_daily(bars).items()}
    assert len(found) == len(want)
    for r in found:
        m = want[r["ticker"], r["trade_date"]]
        assert (r["daily_return"], r["vol_60d_ann"], r["rel_volume_60d"]) == (near(m["ret"]), near(m["vol"]), near(m["rel"]))
        assert (r["running_peak"], r["drawdown"]) == (m["peak"], near(m["drawdown"])) and r["normalized_index"] == near(m["index"])
        assert (r["year"], r["month"]) == (r["trade_date"].year, r["trade_date"].month)


@pytest.mark.parametrize("split", SPLITS)
def test_summary(spark, split):
    """Ties go to the earliest trough, and to the day on which the peak was set first."""
    rows = {r["ticker"]: r for r in summary_metrics(daily_metrics(panel(spark, SERIES), BASE, SPEC, split), BASE, SPEC).collect()}
    for name, bars in SERIES.items():
        m, row = plain_daily(bars), rows[name]
        deepest = min(x["drawdown"] for x in m.values())
        trough = min(d for d, x in m.items() if x["drawdown"] == deepest)
        returns = [x["ret"] for x in m.values() if x["ret"] is not None]
        assert row["total_return"] == near(bars[-1][1] / bars[0][1] - 1) and row["max_drawdown"] == near(deepest)
        assert (row["trough_date"], row["peak_date"]) == (trough, m[trough]["peak_day"])
        assert row["vol_full_ann"] == near(statistics.stdev(returns) * math.sqrt(252))
        assert row["current_drawdown"] == near(m[bars[-1][0]]["drawdown"])
        assert (row["base_date"], row["last_trade_date"]) == (BASE, bars[-1][0])


def test_entity_without_a_base_bar_has_null_index_and_return(spark):
    late = {"P": SERIES["P"], "S": SERIES["Q"][3:]}
    daily = daily_metrics(panel(spark, late), BASE, SPEC)
    assert daily.filter("ticker = 'S' AND normalized_index IS NOT NULL").isEmpty()
    assert summary_metrics(daily, BASE, SPEC).filter("ticker = 'S'").first()["total_return"] is None
    first = monthly_metrics(daily, BASE, SPEC).filter("ticker = 'S'").orderBy("month_start").first()
    assert first["monthly_return"] is None and first["is_partial"]


def test_split_and_whole_series_agree_on_a_skewed_panel(spark):
    """One entity holds most rows, with long flagged stretches across block and chunk borders."""
    days = F.expr("date_add(date'2000-01-03', cast(id as int))")
    price = (F.lit(100) + (F.col("id") * 37) % 41 + F.sin(F.col("id") / 9.0) * 20).cast("double")
    idle = ((F.col("id") % 97) < 30) | ((F.col("id") % 5) == 0)
    hot = spark.range(3000).select(F.lit("HOT").alias("ticker"), days.alias("trade_date"), price.alias("adjclose"), "id")
    cold = spark.range(40).select(F.lit("COLD").alias("ticker"), days.alias("trade_date"), price.alias("adjclose"), "id")
    bars = hot.unionByName(cold).select(
        "ticker", "trade_date", F.col("adjclose").alias("close"), "adjclose",
        F.when(idle, 0).otherwise(F.col("id") % 13 + 1).cast("bigint").alias("volume"),
        F.when(idle, "zero_partial").otherwise("normal").alias("volume_status"),
    )
    spec, base = PanelSpec(vol_window=20, rel_volume_window=15), datetime.date(2000, 1, 10)
    whole = daily_metrics(bars, base, spec)
    for split in (SeriesSplit(block_days=25, chunk_rows=20), SeriesSplit(block_days=700, chunk_rows=64)):
        pieces = daily_metrics(bars, base, spec, split)
        assert pieces.exceptAll(whole).isEmpty() and whole.exceptAll(pieces).isEmpty()
    with pytest.raises(ValueError, match="chunk_rows"):
        daily_metrics(bars, base, spec, SeriesSplit(chunk_rows=19))


# ---------------------------------------------------------------- periods

@pytest.mark.parametrize("n", [45, 50, 51, 70])
def test_periods(spark, n):
    """The last month and year are partial until their last weekday is there, an entity's first ones always."""
    series = {"P": walk(7, n), "Q": walk(8, n)[9:]}
    last = series["P"][-1][0]
    daily = daily_metrics(panel(spark, series), BASE, SPEC)
    kinds = (
        (monthly_metrics, "month_start", "monthly_return", lambda d: d.replace(day=1)),
        (yearly_metrics, "year", "yearly_return", lambda d: d.year),
    )
    for metrics, column, measure, period in kinds:
        found = {(r["ticker"], r[column]): r for r in metrics(daily, BASE, SPEC).collect()}
        assert set(found) == {(t, period(d)) for t, bars in series.items() for d, *_ in bars}
        for name, bars in series.items():
            periods = sorted({period(d) for d, *_ in bars})
            before = bars[0][1] if bars[0][0] == BASE else None
            for k, own in enumerate(periods):
                rows = [b for b in bars if period(b[0]) == own]
                r, traded = found[name, own], [b for b in rows if b[3] == "normal"]
                coming = any(period(d) == own and d > last for d in weekdays(last, 300))
                assert r["is_partial"] == (k == 0 or rows[-1][0] == last and coming)
                assert r[measure] == (None if before is None else near(rows[-1][1] / before - 1))
                assert r["n_sessions"] == len(rows)
                if column == "month_start":
                    assert r["n_normal_sessions"] == len(traded)
                    assert r["avg_daily_volume"] == near(statistics.mean(b[2] for b in traded))
                before = rows[-1][1]


# ---------------------------------------------------------------- diff, injection, checks

SNAPSHOT = "k STRING, x DOUBLE, s STRING, run_id STRING"


def test_snapshot_diff(spark):
    base = [("a", 1.0, "u", "r1"), ("b", None, "v", "r1"), (None, 3.0, None, "r1")]

    def diff(rows):
        frames = [spark.createDataFrame(r, SNAPSHOT) for r in (base, rows)]
        return snapshot_diff(*frames, ["k"], ("run_id",)).withColumn("result", verdict()).first()

    same = diff([(k, x, s, "r2") for k, x, s, _ in base])
    assert same["result"] == "PASS" and same["rows_prev"] == 3 and same["max_double_diff"] == 0.0
    assert diff([("a", 1.0 + 5e-10, "u", ""), *base[1:]])["result"] == "PASS"
    moved = diff([("a", 1.0 + 2e-9, "u", ""), *base[1:]])
    assert moved["result"] == "FAIL" and moved["max_double_diff"] == pytest.approx(2e-9)
    assert diff([("a", None, "u", ""), *base[1:]])["max_double_diff"] == math.inf
    text = diff([*base[:2], (None, 3.0, "w", "")])
    assert (text["mismatched_non_double"], text["result"]) == (1, "FAIL")
    gone = diff(base[1:])
    assert (gone["missing_rows"], gone["rows_latest"], gone["result"]) == (1, 2, "FAIL")
    copied = diff([*base, base[0]])
    assert (copied["dup_keys"], copied["missing_rows"], copied["result"]) == (1, 0, "FAIL")


def test_snapshot_diff_notes_column_changes_and_counts_only(spark):
    left = spark.createDataFrame([("a", 1.0)], "k STRING, x DOUBLE")
    right = left.withColumn("y", F.lit(1))
    changed = snapshot_diff(left, right, ["k"]).withColumn("result", verdict()).first()
    assert changed["note"] == "other columns: +y" and changed["result"] == "FAIL"
    assert snapshot_diff(right, left, ["k"]).first()["note"] == "other columns: -y"
    assert snapshot_diff(left, right, None).select(verdict()).first()[0] == "PASS"
    assert snapshot_diff(left, right.union(right), None).select(verdict()).first()[0] == "FAIL"


@pytest.mark.parametrize(
    ("change", "result"),
    [
        ({}, "PASS"),
        ({"max_double_diff": 5e-10}, "PASS"),
        ({"max_double_diff": None}, "PASS"),
        ({"max_double_diff": 2e-9}, "FAIL"),
        ({"max_double_diff": math.inf}, "FAIL"),
        ({"rows_latest": 11}, "FAIL"),
        ({"dup_keys": 1}, "FAIL"),
        ({"missing_rows": 1}, "FAIL"),
        ({"mismatched_non_double": 1}, "FAIL"),
        ({"note": "columns differ"}, "FAIL"),
    ],
)
def test_verdict(spark, change, result):
    metrics = dict(rows_prev=10, rows_latest=10, dup_keys=0, missing_rows=0, mismatched_non_double=0,
                   max_double_diff=0.0, note="")
    row = tuple({**metrics, **change}.values())
    assert spark.createDataFrame([row], METRICS_SCHEMA).select(verdict()).first()[0] == result


def exchanges(frame):
    return sum("Exchange hashpartitioning" in line for line in plan_of(frame).splitlines())


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_one_exchange_each(spark):
    frame = spark.createDataFrame([("a", 1.0, "u"), ("b", 2.0, None)], "k STRING, x DOUBLE, s STRING")
    assert exchanges(snapshot_diff(frame, frame, ["k"])) == 1
    bars = spark.createDataFrame([("A", day("01-02"), 1.0, 1.0, 1.0, 1.0, 1.0, 0)], PRICED)
    assert exchanges(entity_profile(bars)) == 1
    daily = daily_metrics(panel(spark, SERIES), BASE, SPEC)
    assert exchanges(daily) == 1 and exchanges(daily_profile(daily, F.lit(BASE), SPEC)) == 1


def test_unmatched_keys(spark):
    left, right = (spark.createDataFrame([(k,) for k in keys], "k INT") for keys in ([1, 2, 2], [2, 3]))
    assert {tuple(r) for r in unmatched_keys(left, right, ["k"]).collect()} == {(1, "left"), (3, "right")}


def test_flags_do_not_move_the_panel(spark):
    """Only the untraded dates are grouped and sent, whatever the planner takes for short; given ones are not looked for."""
    bars = spark.createDataFrame([("A", day("01-02"), 0), ("B", day("01-02"), 0)], "ticker STRING, trade_date DATE, volume BIGINT")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = volume_status(bars)
        assert exchanges(flagged) == 1 and "SortMergeJoin" not in flagged._jdf.queryExecution().executedPlan().toString()
        given = volume_status(bars, untraded=local_rows(spark, [(day("01-02"), True)], "trade_date DATE, _untraded BOOLEAN"))
        assert exchanges(given) == 0 and given.collect() == flagged.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_replace_row_with_previous(spark):
    rows = [("A", day(f"01-0{i}"), float(i)) for i in range(1, 6)] + [("B", day("01-01"), 9.0)]
    frame = spark.createDataFrame(rows, "ticker STRING, trade_date DATE, close DOUBLE")
    edited = replace_row_with_previous(frame, "ticker", "trade_date", "A", 3)
    got = sorted(tuple(r) for r in edited.collect())
    assert got == sorted([rows[0], rows[1], rows[1], rows[3], rows[4], rows[5]])
    for bad in (0, 1, 6):
        with pytest.raises(ValueError, match="2..5"):
            replace_row_with_previous(frame, "ticker", "trade_date", "A", bad)


def test_checks(spark):
    measures = spark.createDataFrame([(0, 3)], "none INT, some INT")
    checks = [
        Check("a", "CRITICAL", F.col("none")), Check("b", "WARN", F.col("some")), Check("c", "INFO", F.col("some")),
        Check("d", "CRITICAL", F.lit(None).cast("int")),
    ]
    got = {r["check_name"]: (r["passed"], r["failing_count"]) for r in evaluate(measures, "x", checks).collect()}
    assert got == {"a": (True, 0), "b": (False, 3), "c": (True, 3), "d": (False, None)}
    with pytest.raises(ValueError, match="severity"):
        Check("e", "FATAL", F.col("none"))


def test_spec_is_immutable():
    with pytest.raises(dataclasses.FrozenInstanceError):
        SPEC.vol_window = 5
