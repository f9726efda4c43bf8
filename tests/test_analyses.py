"""Performance of ranges, episodes, coarse bars, rescued fields and drift on panels and files made for the case."""

import csv
import datetime
import io
import json
import random
import statistics

import pytest
from pyspark.sql import functions as F

from barloom.operators.episodes import EPISODE_COLUMNS, drawdown_episodes
from barloom.operators.labels import FIELDS, month_after, reconcile_bars, week_after
from barloom.operators.performance import (
    PERFORMANCE_COLUMNS,
    block_summaries,
    register_window_performance,
    store_blocks,
    window_performance,
)
from barloom.sources.drift import document_drift, inferred_schema, landed_documents
from barloom.sources.landing import line_fields, read_lines

DAY_ONE = datetime.date(2020, 1, 1)


def random_panel(seed, n_entities=4, n_days=150):
    """(ticker, trade_date, adjclose, volume_status) with ties in price, gaps, flagged days and one lone bar."""
    rng, rows = random.Random(seed), [("lone", DAY_ONE + datetime.timedelta(40), 5.0, "normal")]
    for e in range(n_entities):
        price = 10.0
        for d in range(n_days):
            if rng.random() < 0.2:
                continue
            normal = rng.random() > 0.15
            price = max(1.0, price + rng.choice([-2.0, -1.0, 0.0, 1.0, 1.5])) if normal else price
            rows.append((f"e{e}", DAY_ONE + datetime.timedelta(d), price, "normal" if normal else "zero_partial"))
    return rows


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame(random_panel(3), "ticker string, trade_date date, adjclose double, volume_status string")


def plain_performance(rows, start, end):
    out = {}
    for ticker in {r[0] for r in rows}:
        days = sorted(r[1:] for r in rows if r[0] == ticker and start <= r[1] <= end)
        if not days:
            continue
        normal = [p for _, p, status in days if status == "normal"]
        steps = [b / a - 1 for a, b in zip(normal, normal[1:])]
        peak, peak_day, deepest = 0.0, None, None
        for day, price, _ in days:
            if price > peak:
                peak, peak_day = price, day
            if deepest is None or price / peak - 1 < deepest[0]:
                deepest = (price / peak - 1, day, peak_day)
        out[ticker] = (
            days[0][0], days[-1][0], len(days), len(steps), days[-1][1] / days[0][1] - 1,
            statistics.stdev(steps) * 252**0.5 if len(steps) > 1 else None, deepest[0], deepest[2], deepest[1], days[-1][1] / peak - 1,
        )
    return out


def same(a, b):
    return all(x == y or (isinstance(x, float) and isinstance(y, float) and abs(x - y) < 1e-9) for x, y in zip(a, b, strict=True))


@pytest.mark.parametrize("days", [1, 7, 32, 400])
def test_window_performance_of_random_ranges(spark, panel, tmp_path, days):
    rows, rng = [tuple(r) for r in panel.collect()], random.Random(days)
    name = f"performance_{days}"
    store_blocks(panel, str(tmp_path), days=days)
    register_window_performance(spark, str(tmp_path), name, days=days)
    ranges = [(0, 149), (40, 40), (10, 9), (-50, 500), (300, 400)] + [sorted(rng.sample(range(-5, 160), 2)) for _ in range(4)]
    for a, b in ranges:
        start, end = DAY_ONE + datetime.timedelta(a), DAY_ONE + datetime.timedelta(b)
        found = {r["ticker"]: tuple(r[c] for c in PERFORMANCE_COLUMNS) for r in window_performance(spark, start, end, name).collect()}
        want = plain_performance(rows, start, end)
        assert found.keys() == want.keys() and all(same(found[t], want[t]) for t in want), (a, b)


def test_window_performance_reads_two_edge_blocks(spark, panel, tmp_path):
    store_blocks(panel, str(tmp_path), days=7)
    register_window_performance(spark, str(tmp_path), "edges", days=7)
    start, end = DAY_ONE + datetime.timedelta(10), DAY_ONE + datetime.timedelta(130)
    frame = window_performance(spark, start, end, "edges")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    bars = next(line for line in plan.splitlines() if "/bars" in line)
    assert "PartitionFilters: [block" in bars and "block#" in bars.split("PartitionFilters:")[1]


def test_summaries_of_blocks_have_one_row_each(spark, panel):
    found = block_summaries(panel, days=7)
    assert found.groupBy("ticker", "block").count().where("count > 1").isEmpty()
    assert found.agg(F.sum("n_bars")).first()[0] == panel.count()
    assert block_summaries(panel.limit(0)).count() == 0


def plain_episodes(rows):
    out = []
    for ticker in {r[0] for r in rows}:
        days = sorted((r[1], r[2]) for r in rows if r[0] == ticker and r[2] is not None)
        for i, (day, price) in enumerate(days):
            if any(p > price for _, p in days[:i]):
                continue
            back = next((j for j in range(i + 1, len(days)) if days[j][1] >= price), None)
            below = days[i + 1 : back]
            if below:
                low, low_day = min((p, d) for d, p in below)
                recovery = days[back][0] if back else None
                out.append((
                    ticker, day, low_day, recovery, price, low, low / price - 1, len(below), (low_day - day).days, (recovery - day).days if back else None,
                ))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_episodes(spark, seed):
    rows = random_panel(seed) + [("up", DAY_ONE + datetime.timedelta(d), float(d + 1), "normal") for d in range(5)]
    rows += [("gap", DAY_ONE, 5.0, "normal"), ("gap", DAY_ONE + datetime.timedelta(1), None, "normal"), ("gap", DAY_ONE + datetime.timedelta(2), 4.0, "normal")]
    frame = spark.createDataFrame(rows, "ticker string, trade_date date, adjclose double, volume_status string")
    found = drawdown_episodes(frame).select("ticker", *EPISODE_COLUMNS).collect()
    assert sorted(map(tuple, found), key=str) == plain_episodes(rows)
    assert drawdown_episodes(frame.limit(0)).count() == 0


def test_coarse_bars(spark):
    """Labels that lie anywhere in the week, one per entity and start, an empty period, a day of no label, nulls."""
    rng, daily, coarse = random.Random(4), [], []
    for e, offset in (("a", 0), ("b", 3)):
        for w in range(12):
            label = DAY_ONE + datetime.timedelta(7 * w + offset)
            days = [label + datetime.timedelta(d) for d in range(1, 8) if rng.random() > 0.3 and w != 5]
            bars = [(e, d, *(float(rng.randint(1, 50)) for _ in range(4)), rng.randint(0, 9)) for d in days]
            daily += bars
            if w == 7 or not (bars or w == 5):
                continue
            values = [bars[0][2], max(b[3] for b in bars), min(b[4] for b in bars), bars[-1][5], sum(b[6] for b in bars)] if bars else [1.0, 1.0, 1.0, 1.0, 1]
            if w == 2:
                values[0], values[4] = None, values[4] + 1
            if w == 3:
                values[3] += 1e-9
            coarse.append((e, label, *values))
    ddl = "open double, high double, low double, close double, volume bigint"
    days = spark.createDataFrame(daily, f"ticker string, trade_date date, {ddl}")
    weeks = spark.createDataFrame(coarse, f"ticker string, label date, {ddl}")
    found = reconcile_bars(days, weeks, week_after, 7)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and plan.count("bin#") > 2
    named = {(r["ticker"], r["label"]): r["difference"] for r in found.collect()}
    for e, offset in (("a", 0), ("b", 3)):
        label = lambda w: DAY_ONE + datetime.timedelta(7 * w + offset)
        assert named[e, label(2)] == "open,volume" and named[e, label(5)] == "no daily bars" and named[e, None] == "no label"
        assert named[e, label(3)] == named[e, label(0)] == "" and (e, label(7)) not in named
    # Any width of the bins gives the same.
    assert {(r["ticker"], r["label"]): r["difference"] for r in reconcile_bars(days, weeks, week_after, 3).collect()} == named
    months = spark.createDataFrame([("a", datetime.date(2020, 1, 31), 1.0, 1.0, 1.0, 1.0, 1)], f"ticker string, label date, {ddl}")
    february = reconcile_bars(days, months, month_after, 32).where("label IS NOT NULL").first()
    assert february["n_sessions"] == sum(d[0] == "a" and d[1].month == 2 for d in daily) and FIELDS[0] in february["difference"]


def test_fields_of_lines(spark):
    rows = [["a", "b,c", "", 'd "e"', "\\"], [""], ["", ""], ["x"], ['"'], ["a b", "é,𝄞", "1"]]
    lines = []
    for row in rows:
        text = io.StringIO()
        csv.writer(text, doublequote=False, escapechar="\\", lineterminator="", quoting=csv.QUOTE_ALL).writerow(row)
        lines.append((text.getvalue(), row))
    lines += [("a,,b,", ["a", "", "b", ""]), (",", ["", ""]), ('a"b,c', ['a"b', "c"]), ('"open,b', ['"open', "b"])]
    frame = spark.createDataFrame(lines, "line string, want array<string>")
    assert frame.where(line_fields(F.col("line")) != F.col("want")).collect() == []


def test_rescued_places(spark, tmp_path):
    (tmp_path / "f.csv").write_text('x,y,z\n1,2,3\n1,2,3,4,,"5,6"\n1\n"a,b",2,3\n1,2\n')
    found = [(r["x"], r["y"], r["z"], json.loads(r["_rescued_data"]) if r["_rescued_data"] else None) for r in read_lines(spark, str(tmp_path / "*.csv"), ("x", "y", "z")).collect()]
    assert found == [
        ("1", "2", "3", None), ("1", "2", "3", {"3": "4", "4": "", "5": "5,6"}), ("1", None, None, {"1": None, "2": None}), ("a,b", "2", "3", None),
        ("1", "2", None, {"2": None}),
    ]
    assert read_lines(spark, str(tmp_path / "*.csv"), ("x", "y", "z")).where("_rescued_data IS NULL").select("y").count() == 2


def test_drift(spark, tmp_path):
    schema = "a struct<b: bigint, c: string>, d string, e boolean"
    good = {"a": {"b": 1, "c": "x"}, "d": "y", "e": True}
    files = {
        "good": good, "null": {**good, "d": None}, "added": {**good, "f": [{"g": 1}, {"g": "t"}, 5]}, "missing": {"a": {"b": 1, "c": "x"}},
        "retyped": {**good, "a": "text", "e": 1.5}, "empty": {}, "list": [1, 2],
    }
    for name, document in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(document, indent=1))
    (tmp_path / "broken.json").write_text("{")
    documents = landed_documents(spark, str(tmp_path / "*.json"))
    name = F.regexp_extract("source_file", r"([a-z]+)\.json", 1)
    found = {}
    for r in document_drift(documents, schema).select(name.alias("n"), "path", "change", "found").collect():
        found.setdefault(r["n"], set()).add((r["path"], r["change"], r["found"]))
    every = {(p, "missing", None) for p in ("a", "a.b", "a.c", "d", "e")}
    assert found == {
        "added": {("f", "added", "ARRAY"), ("f[]", "added", "BIGINT|OBJECT"), ("f[].g", "added", "BIGINT|STRING")},
        "missing": {("d", "missing", None), ("e", "missing", None)},
        "retyped": {("a", "retyped", "STRING"), ("a.b", "missing", None), ("a.c", "missing", None), ("e", "retyped", "DECIMAL")},
        "empty": every,
        "list": every | {("[]", "added", "BIGINT")},
        "broken": {("", "not JSON", None)},
    }
    assert "a: VARIANT" in inferred_schema(documents.where(name.isin("good", "retyped"))).first()[0]
