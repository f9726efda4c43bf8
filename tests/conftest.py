import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from barloom.session import local_session  # noqa: E402
from barloom.settings import Settings  # noqa: E402
from barloom.spec import PanelSpec  # noqa: E402

# Two entities, small windows: dates 01-01 (nobody trades) and 01-06 (only A trades) are the flagged ones.
BARS = {
    "A": [
        ("2020-01-01", "10", "10", "10", "10", "10", "0"),
        ("2020-01-02", "10", "12", "9", "11", "11", "100"),
        ("2020-01-03", "11", "13", "10", "12", "12", "110"),
        ("2020-01-06", "12", "12", "11", "11", "11", "120"),
        ("2020-01-07", "11", "12", "10", "10", "10", "130"),
        ("2020-02-03", "10", "12", "9", "11", "11", "140"),
    ],
    "B": [
        ("2020-01-01", "20", "20", "20", "20", "20", "0"),
        ("2020-01-02", "20", "22", "19", "21", "21", "200"),
        ("2020-01-03", "21", "23", "20", "22", "22", "210"),
        ("2020-01-06", "22", "22", "22", "22", "22", "0"),
        ("2020-01-07", "22", "25", "21", "24", "24", "230"),
        ("2020-02-03", "24", "24", "17", "18", "18", "240"),
    ],
}
UNIVERSE = [
    {"ticker": t, "source_symbol": f"{t}.X", "folder": t.lower(), "bank_name": f"{t} Holding", "short_name": t}
    for t in BARS
]
HEADER = "Date,open,high,low,close,adjclose,volume,ingested_at_utc"
STAMP = "2026-10-09 05:43:40.875883+00:00"


def land(root: Path, bars=BARS, run_id="R1", declared=None, symbol=None, header=HEADER):
    """Write landing files: one folder per entity with a CSV and a run summary."""
    for ticker, rows in bars.items():
        folder = root / ticker.lower()
        folder.mkdir(parents=True, exist_ok=True)
        lines = [header] + [",".join((*row, STAMP)) for row in rows]
        (folder / f"{ticker}.X.csv").write_text("\n".join(lines) + "\n")
        daily = {"date_max": max(r[0] for r in rows), "duplicate_dates": 0, "rows": declared or len(rows)}
        document = {
            "run_id": run_id,
            "stock": ticker,
            "ticker": symbol or f"{ticker}.X",
            "intervals": {"1d": daily, "1mo": daily, "1wk": daily},
        }
        (folder / "run-summary.json").write_text(json.dumps(document, indent=2))
    return str(root)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "barloom-tests", memory="4g", folder=str(tmp_path_factory.mktemp("spark")))
    yield session
    session.stop()


@pytest.fixture
def settings(tmp_path):
    """Settings with schema names of their own, so that tests do not share catalog tables."""
    tag = tmp_path.name.replace("-", "_")
    return Settings(
        warehouse=str(tmp_path / "warehouse"),
        landing_path=land(tmp_path / "landing"),
        universe=UNIVERSE,
        schemas={layer: f"{layer}_{tag}" for layer in ("bronze", "silver", "gold", "ops")},
        panel=PanelSpec(vol_window=2, rel_volume_window=2),
    )
