"""The queries that SQL can express, against it."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from barloom.llm.queries import ORACLE, QUERIES  # noqa: E402
from oracle_compare import compare, connect  # noqa: E402
from plain import SF  # noqa: E402


def test_every_operator_has_a_query():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    problem, rows = compare(spark, connect(SF), QUERIES[name], ORACLE[name], SF)
    assert not problem and rows
