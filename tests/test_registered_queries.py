"""Every registered query against its SQL at the smallest scale, and the properties that hold for any panel."""

import functools
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from barloom.queries import layers as layers_of_panel  # noqa: E402
from barloom.queries import registry  # noqa: E402
from barloom.queries.layers import series_layers, supplier_layers  # noqa: E402
from barloom.queries.oracle import ORACLE  # noqa: E402
from barloom.session import stored  # noqa: E402
from oracle_compare import compare, connect  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.fixture(scope="module", autouse=True)
def shared_layers():
    """The layers of a panel are built once for all queries of this module."""
    kept = {name: getattr(registry, name) for name in ("series_layers", "supplier_layers")}
    for name, build in kept.items():
        setattr(registry, name, functools.cache(build))
    yield
    for name, build in kept.items():
        setattr(registry, name, build)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(ORACLE)
    assert set(registry.QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_matches_sql(spark, con, name):
    problem, _ = compare(spark, con, registry.QUERIES[name], ORACLE[name], SF_DIR)
    assert not problem


def test_entry(spark):
    rows = entry(spark).collect()
    assert [r["ticker"] for r in sorted(rows)] == ["A", "N", "R"]


def test_properties(spark):
    layers = supplier_layers(spark, SF_DIR)
    fact = layers.fact
    assert fact.filter("drawdown > 0 OR running_peak < adjclose").isEmpty()
    at_base = fact.filter(F.col("trade_date") == layers.base)
    assert at_base.filter("abs(normalized_index - 100) > 1e-9").isEmpty() and not at_base.isEmpty()
    long = series_layers(spark, SF_DIR)
    assert long.silver.filter("(volume > 0) <> (volume_status = 'normal')").isEmpty()
    assert long.daily.filter("volume_status <> 'normal' AND (daily_return IS NOT NULL OR vol_60d_ann IS NOT NULL)").isEmpty()


@pytest.mark.parametrize("name", ["peak_and_trough_rows", "compounding_check"])
def test_no_rolling_measure_is_stored_for_queries_without_one(spark, monkeypatch, name):
    """Nor are the bars of the suppliers written twice."""
    written = []
    monkeypatch.setattr(layers_of_panel, "stored", lambda frame: written.append(frame.columns) or stored(frame))
    monkeypatch.setattr(registry, "supplier_layers", supplier_layers)
    assert not registry.QUERIES[name](spark, SF_DIR).isEmpty()
    assert [columns for columns in written if {"vol_60d_ann", "rel_volume_60d"} & set(columns)] == []
    assert sum("adjclose" in columns for columns in written) == 1
