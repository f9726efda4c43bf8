"""The files that a panel is landed as."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barloom.queries.landed import land, write_folders
from barloom.sources.landing import landed_files, scan


def test_one_file_per_entity_and_kind(spark, tmp_path):
    """Rows of every entity lie in every partition, and still each entity has one file; the summaries are not left to one task."""
    bars = spark.range(0, 60, 1, 6).select(
        F.concat(F.lit("T"), F.col("id") % 5).alias("ticker"),
        F.date_add(F.lit("2020-01-01"), F.col("id").cast("int")).alias("trade_date"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "adjclose")],
        F.lit(1).cast("bigint").alias("volume"),
    )
    land(bars, str(tmp_path))
    files = sorted(str(p.parent.name) for p in Path(tmp_path, "daily").glob("*/*.csv"))
    assert files == [f"folder=T{i}" for i in range(5)]
    summaries = list(Path(tmp_path, "summaries").glob("*/*.json"))
    assert len(summaries) == 5 and len({p.name.split("-")[1] for p in summaries}) > 1
    assert spark.read.option("header", True).csv(f"{tmp_path}/daily").count() == 60


def lines_by_folder(root) -> dict[str, list[str]]:
    """Per folder the lines of its files, sorted; hidden files count for nothing."""
    parts = [p for p in Path(root).glob("*/part-*") if p.is_file()]
    folders = {p.parent.name for p in parts}
    return {f: sorted(line for p in parts if p.parent.name == f for line in p.read_text().splitlines()) for f in folders}


@pytest.mark.parametrize("kind", ["csv", "json"])
def test_folders_are_those_of_sparks_writer(spark, tmp_path, kind):
    """Names that a path must encode, rows without a folder, values to be quoted or absent; also in a store that tasks cannot open."""
    names = ["a", "A b+", "50%/x", 'q"#', "k=v:w", "{[^]}'", "é", "", None, "\t"]
    values = ["plain", "a,b", 'say "hi"', "", None, " padded ", "back\\slash", "é"]
    rows = spark.createDataFrame(
        [(n, v, i if i % 3 else None) for i, (n, v) in enumerate((n, v) for v in values for n in names)],
        "folder STRING, text STRING, number INT",
    ).repartition(2, "folder")
    rows.write.partitionBy("folder").options(**({"header": True} if kind == "csv" else {})).format(kind).save(f"{tmp_path}/spark")
    write_folders(rows, f"{tmp_path}/tasks", kind)
    want = lines_by_folder(tmp_path / "spark")
    assert lines_by_folder(tmp_path / "tasks") == want and len(want) == len(names) - 1
    spark._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.landed{kind}.link./in", f"file://{tmp_path}")
    write_folders(rows, f"viewfs://landed{kind}/in/other", kind)
    assert lines_by_folder(tmp_path / "other") == want
    with pytest.raises(FileExistsError):
        write_folders(rows, f"{tmp_path}/tasks", kind)


def test_a_landed_file_has_no_other_beside_it(spark, tmp_path):
    bars = spark.range(20).select(
        F.concat(F.lit("T"), F.col("id") % 5).alias("ticker"),
        F.date_add(F.lit("2020-01-01"), F.col("id").cast("int")).alias("trade_date"),
        *[F.lit(1.5).alias(c) for c in ("open", "high", "low", "close", "adjclose")],
        F.lit(1).cast("bigint").alias("volume"),
    )
    land(bars, str(tmp_path))
    for kind, folder in (("csv", "daily"), ("json", "summaries")):
        assert [p.suffix for p in Path(tmp_path, folder).glob("*/*")] == [f".{kind}"] * 5


def test_folders_are_listed_by_a_few_tasks(spark, tmp_path):
    """One task per folder is what the default setting would start."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    for i in range(60):
        (tmp_path / f"f{i}").mkdir()
        (tmp_path / f"f{i}" / "x.csv").write_text("1\n")
    before = spark.conf.get(name)
    tracker = spark.sparkContext.statusTracker()
    try:
        for setting, most in (("10000", 4 * spark.sparkContext.defaultParallelism), ("3", 3)):
            spark.conf.set(name, setting)
            spark.sparkContext.setJobGroup(f"listing {setting}", "listing")
            listed = scan(spark, f"{tmp_path}/*/*.csv", "text")
            jobs = tracker.getJobIdsForGroup(f"listing {setting}")
            tasks = [tracker.getStageInfo(s).numTasks for j in jobs for s in tracker.getJobInfo(j).stageIds]
            assert tasks and max(tasks) <= most
            assert spark.conf.get(name) == setting and listed.count() == 60
    finally:
        spark.conf.set(name, before)
        spark.sparkContext._jsc.clearJobGroup()
    assert landed_files(spark, f"{tmp_path}/*/*.csv").count() == 60
