"""Histories of versions, comparison by checksums, exact sums, level alerts, and the layout for serving."""

import datetime
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barloom.functions.exact import exact_deviation, exact_sum
from barloom.operators.alerts import level_alerts
from barloom.operators.checksums import bucket_checksums, differing_buckets, two_stage_diff
from barloom.operators.daily import daily_metrics
from barloom.operators.diff import snapshot_diff, verdict
from barloom.operators.flags import key_profile
from barloom.operators.history import as_of, fold_versions, restated_per_version, restatements
from barloom.operators.summary import summary_metrics
from barloom.plans.compare import COMPARED, rerun_report, store_checksums
from barloom.plans.layout import store_for_serving
from barloom.session import stored
from barloom.sources.catalog import set_up
from barloom.sources.store import SnapshotStore

TABLE = "k bigint, name string, x double"


def random_versions(seed, n=6):
    rng = random.Random(seed)
    rows, out = [(i, rng.choice("abc"), float(rng.randint(0, 3))) for i in range(30)], []
    for _ in range(n):
        rows = [r for r in rows if rng.random() > 0.1]
        rows = [(k, name, rng.choice([x, x, x, None])) for k, name, x in rows] + rng.choices(rows or [(0, "a", 0.0)], k=2)
        rows += [(rng.randint(0, 60), None, float("nan") if rng.random() < 0.1 else 1.5)]
        out.append(list(rows) if rng.random() > 0.1 else [])
    return out


def bag(rows):
    return Counter(str(tuple(r)) for r in rows)


@pytest.mark.parametrize("seed", range(3))
def test_history_rebuilds_every_version(spark, seed):
    versions = random_versions(seed)
    history = stored(fold_versions([spark.createDataFrame(v, TABLE) for v in versions]))
    for i, rows in enumerate(versions):
        assert bag(as_of(history, i).collect()) == bag(spark.createDataFrame(rows, TABLE).collect())
    # Nothing is told twice: two stretches of a content in the same number do not touch.
    again = history.alias("a").join(history.alias("b"), F.expr("a.k <=> b.k AND a.name <=> b.name AND a.x <=> b.x AND a.copies = b.copies AND a.valid_to = b.valid_from"))
    assert again.count() == 0
    by_key = [{k: bag(r for r in v if r[0] == k) for k in {r[0] for r in v}} for v in versions]
    for a, b in ((0, 1), (1, 4), (5, 2), (3, 3)):
        found = {r["k"]: r["change"] for r in restatements(history, ["k"], a, b).collect()}
        keys = by_key[a].keys() | by_key[b].keys()
        want = {k: "added" if k not in by_key[a] else "removed" if k not in by_key[b] else "changed" for k in keys if by_key[a].get(k) != by_key[b].get(k)}
        # A key that keeps one of its contents and gains another has rows on one side only that moved.
        assert found.keys() == want.keys() and all(found[k] == want[k] for k in want if by_key[a].get(k, Counter()).total() <= 1 >= by_key[b].get(k, Counter()).total())
    told = restated_per_version(history, ["k"], len(versions)).count()
    assert told == len(versions) - 1


def test_restated_columns(spark):
    before = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", None), (5, "e", 1.0)], TABLE)
    after = spark.createDataFrame([(1, "a", 1.5), (2, "z", None), (3, "c", None), (4, "d", 4.0)], TABLE)
    history = fold_versions([before, after, after])
    found = {tuple(r) for r in restatements(history, ["k"], 0, 2).collect()}
    assert found == {(1, "changed", "x"), (2, "changed", "name,x"), (4, "added", ""), (5, "removed", "")}
    assert [tuple(r) for r in restated_per_version(history, ["k"], 3).orderBy("version").collect()] == [(1, 1, 1, 2), (2, 0, 0, 0)]


def test_two_stage_diff_reads_differing_buckets_only(spark):
    rows = [(i, f"n{i % 7}", i / 3) for i in range(2000)] + [(7, "twice", None), (None, "no key", 1.0)]
    table = stored(spark.createDataFrame(rows, TABLE))
    sums = bucket_checksums(table, ["k"], buckets=64)
    assert differing_buckets(sums, bucket_checksums(table.repartition(13).select("x", "k", "name"), ["k"], buckets=64)) == []
    cases = {
        "same": (table.repartition(5), 0),
        "bits": (table.withColumn("x", F.when(F.col("k") == 5, F.col("x") + 1e-12).otherwise(F.col("x"))), 1),
        "value": (table.withColumn("name", F.when(F.col("k") == 5, F.lit("other")).otherwise(F.col("name"))), 1),
        "lost": (table.where("k IS NOT NULL"), 1),
        "twice": (table.unionByName(table.where("k IN (3, 4)")), 2),
        "null": (table.withColumn("x", F.when(F.col("k") != 9, F.col("x"))), 2),
    }
    for name, (other, buckets) in cases.items():
        other_sums = bucket_checksums(other, ["k"], buckets=64)
        found = two_stage_diff(table, other, sums, other_sums, ["k"], buckets=64).withColumn("result", verdict()).first()
        assert found == snapshot_diff(table, other, ["k"]).withColumn("result", verdict()).first(), name
        assert len(differing_buckets(sums, other_sums)) <= buckets
    plan = two_stage_diff(table, cases["same"][0], sums, sums, ["k"], buckets=64)._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation <empty>" in plan and "Relation [k" not in plan
    other = table.withColumn("more", F.lit(1))
    assert two_stage_diff(table, other, sums, bucket_checksums(other, ["k"]), ["k"]).first()["note"] == "other columns: +more"


def test_sums_do_not_depend_on_the_partitions(spark):
    rng = random.Random(1)
    rows = [(i % 3, rng.choice([1e-9, 1.0, 1e6]) * rng.uniform(-1, 1)) for i in range(5000)] + [(3, 1.0), (4, None)]
    frame = spark.createDataFrame(rows, "g int, x double")
    kept = []
    for n in (1, 7, 64):
        found = frame.repartition(n, F.rand(n)).groupBy("g").agg(exact_sum(F.col("x")).alias("s"), exact_deviation(F.col("x")).alias("d"))
        kept.append({r["g"]: (r["s"], r["d"]) for r in found.collect()})
    assert kept[0] == kept[1] == kept[2] and kept[0][3] == (1.0, None) and kept[0][4] == (None, None)
    for g in range(3):
        values = [x for i, x in rows if i == g]
        assert abs(kept[0][g][1] / statistics.stdev(values) - 1) < 1e-12
    day = datetime.date(2020, 1, 1)
    bars = [(t, day + datetime.timedelta(d), rng.uniform(5, 20), rng.uniform(5, 20), 10 + d, "normal") for t in "ab" for d in range(300)]
    panel = spark.createDataFrame(bars, "ticker string, trade_date date, close double, adjclose double, volume bigint, volume_status string")
    sums = {tuple(map(str, sorted(map(tuple, summary_metrics(daily_metrics(panel.repartition(n), day).repartition(n, F.rand(n)), day).collect())))) for n in (1, 7, 64)}
    assert len(sums) == 1


def test_level_alerts(spark):
    day = datetime.date(2024, 1, 1)
    rng = random.Random(2)
    values = {
        "calm": [rng.randint(8, 12) for _ in range(200)],
        "up": [rng.randint(8, 12) for _ in range(30)] + [rng.randint(98, 102) for _ in range(30)],
        "down": [rng.randint(98, 102) for _ in range(20)] + [rng.randint(8, 12) for _ in range(40)],
        "both": [0] * 20 + [50] * 20 + [0] * 20,
        "short": [1, 900],
        "gaps": [None, 3, None, *[3] * 8, 90],
    }
    rows = [(c, day + datetime.timedelta(i), v) for c, runs in values.items() for i, v in enumerate(runs)]
    frame = spark.createDataFrame(rows, "check_name string, checked_at date, failing_count bigint").repartition(4)
    found = level_alerts(frame)
    assert found.count() == sum(v is not None for runs in values.values() for v in runs)
    told = sorted((r["check_name"], (r["checked_at"] - day).days, r["alert"]) for r in found.where("alert IS NOT NULL").collect())
    assert told == [("both", 20, "up"), ("both", 40, "down"), ("down", 20, "down"), ("gaps", 11, "up"), ("up", 30, "up")]
    assert level_alerts(frame.limit(0)).count() == 0


def test_serving_layout(spark, tmp_path):
    day = datetime.date(2020, 1, 1)
    fact = spark.range(40).crossJoin(spark.range(500).withColumnRenamed("id", "d")).select(
        F.concat(F.lit("t"), "id").alias("ticker"), F.date_add(F.lit(day), F.col("d").cast("int")).alias("trade_date"), F.rand(1).alias("adjclose")
    )
    dim = fact.select("ticker").distinct().withColumn("short_name", F.upper("ticker"))
    spark.sql(f"CREATE SCHEMA layout_test LOCATION '{tmp_path}/db'")
    tables = store_for_serving(spark, {"fact": fact, "dim": dim}, "layout_test", str(tmp_path / "t"), 8, row_group_bytes=4096)
    joined = tables["fact"].join(tables["dim"].hint("merge"), "ticker")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan and joined.count() == 40 * 500
    chosen = tables["fact"].where("ticker = 't7' AND trade_date = DATE '2020-06-01'")
    # Buckets are left out in any case; the plan tells so where they are kept apart.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    plan = tables["fact"].where("ticker = 't7' AND trade_date = DATE '2020-06-01'")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 8" in plan and "EqualTo(ticker,t7)" in plan and "EqualTo(trade_date,2020-06-01)" in plan
    assert chosen.count() == 1
    # The sorted row groups of a file do not all overlap a date: some are left out.
    import pyarrow.parquet as pq

    path = next(p for p in (tmp_path / "t" / "fact").glob("*.parquet") if pq.ParquetFile(p).metadata.num_row_groups > 1)
    meta = pq.ParquetFile(path).metadata
    ranges = [(meta.row_group(i).column(0).statistics.min, meta.row_group(i).column(0).statistics.max) for i in range(meta.num_row_groups)]
    assert ranges == sorted(ranges) and ranges[0][0] < ranges[-1][0]


def test_copies_of_a_key_merge_before_they_move(spark):
    """An entity flooded with copies sends one row a day to the window."""
    rows = spark.range(200_000).select(
        F.lit("flood").alias("ticker"), F.date_add(F.lit(datetime.date(2020, 1, 1)), (F.col("id") % 5).cast("int")).alias("trade_date"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "adjclose")], F.lit(0).cast("bigint").alias("volume"),
    )
    profile = key_profile(rows)
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("partial_count") and plan.count("partial_count") >= 1
    assert {r["copies"] for r in profile.collect()} == {40_000}


def test_diff_moves_no_rows_of_equal_buckets(spark):
    """Of the previous side only rows of buckets that differ are grouped; copies, infinite doubles and others count as before."""
    table = spark.range(2000).selectExpr("id AS k", "CAST(id AS DOUBLE) AS x", "CAST(id % 7 AS STRING) AS s")
    changed = table.withColumn("x", F.when(F.col("k") == 5, 0.5).otherwise(F.col("x")))
    for latest, same in ((table, True), (changed, False)):
        diff = snapshot_diff(table, latest, ["k"])
        rows = diff._jdf.queryExecution().optimizedPlan().toString()
        assert "_same" in rows and " IN " in rows.replace("INSET", "IN")
        row = diff.first()
        assert (row["rows_prev"], row["rows_latest"], row["dup_keys"], row["missing_rows"]) == (2000, 2000, 0, 0)
        assert row["max_double_diff"] == (0.0 if same else 4.5)
    twice = table.unionByName(table.where("k < 3"))
    row = snapshot_diff(twice, twice, ["k"]).first()
    assert (row["rows_prev"], row["rows_latest"], row["dup_keys"], row["missing_rows"]) == (2003, 2003, 3, 0)
    endless = table.withColumn("x", F.when(F.col("k") == 5, float("inf")).otherwise(F.col("x")))
    assert str(snapshot_diff(endless, endless, ["k"]).first()["max_double_diff"]) == "nan"


def test_checksums_after_known_ones(spark):
    """The checksums of a later version are the same whether those of the one before are known or not, and group no keys of
    equal buckets."""
    table = spark.range(500).selectExpr("id % 400 AS k", "CAST(id AS DOUBLE) AS x")
    before = bucket_checksums(table, ["k"], buckets=16)
    later = table.unionByName(table.where("k = 7")).where("k <> 9")
    for version in (table, later):
        whole, after = (bucket_checksums(version, ["k"], buckets=16, known=known) for known in (None, before))
        assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, after.collect()))


def test_history_moves_rows_once(spark):
    table = spark.range(20).selectExpr("id AS k", "id % 3 AS x")
    plan = fold_versions([table, table.where("k > 3"), table])._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning" in line for line in plan.splitlines()) == 1
    assert "Window" not in plan


def test_checksums_and_report_read_the_manifest_once_each(spark, settings, monkeypatch):
    """However many tables are compared; the versions are those that ``latest_two`` gives for one table."""
    set_up(spark, settings)
    store = SnapshotStore(spark, settings)
    compared = {table: keys for table, keys in COMPARED.items() if table[0] == "gold"}
    for run, n in (("a", 5), ("b", 4), ("c", 4)):
        frames = {t: spark.range(n).select(*[F.col("id").cast("string").alias(k) for k in keys], F.lit(0.1).alias("x")) for t, keys in compared.items()}
        store.publish(run, "task", [store.stage(*t, frame, run) for t, frame in frames.items()])
    found = store.latest_two_of_each()
    assert found.keys() == compared.keys()
    for table, rows in found.items():
        assert [(r["version"], r["path"]) for r in rows] == [(r["version"], r["path"]) for r in store.latest_two(*table)]
        assert [r["version"] for r in rows] == [2, 1] and store.open(rows[1]).count() == 4
    reads, versions = [], SnapshotStore.versions
    monkeypatch.setattr(SnapshotStore, "versions", lambda self: reads.append(1) or versions(self))
    store_checksums(spark, settings)
    report = rerun_report(spark, settings, tolerance=0.0, checksums=True).collect()
    assert len(reads) == 2
    told = {r["table"].split(".", 1)[1]: (r["version_prev"], r["rows_latest"], r["max_double_diff"], r["result"]) for r in report}
    for layer, name in COMPARED:
        expected = (1, 4, 0.0, "PASS") if (layer, name) in compared else (None, None, None, "SKIPPED")
        assert told[settings.table(layer, name).split(".", 1)[1]] == expected
