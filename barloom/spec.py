"""The panel contract: which columns are the key, and the parameters of the measures."""

from __future__ import annotations

from dataclasses import dataclass

# Column names and enumerations of the data model.
PRICE_COLUMNS = ("open", "high", "low", "close", "adjclose")
REJECT_CODES = (
    "invalid_date",
    "invalid_price",
    "non_positive_price",
    "invalid_volume",
    "ohlc_inconsistent",
    "rescued_data_present",
)
NORMAL = "normal"
ZERO_ALL = "zero_all_tickers"
ZERO_PARTIAL = "zero_partial"

# Prices are 32-bit values stored as double; this absorbs the noise when two of them are compared.
PRICE_TOLERANCE = 1e-6


@dataclass(frozen=True)
class PanelSpec:
    """Key columns and measure parameters.

    ``(entity, date)`` is the key and ``date`` is a DATE, so one entity has at most one row per calendar day. That is
    the size bound every per-entity window in this package rests on: copies of a key are counted and merged by grouped
    aggregates (which combine before the shuffle) and stop a run before any window sees them.

    ``min_coverage`` is the share of entities that must trade on the base date; 1.0 means all of them.
    """

    entity: str = "ticker"
    date: str = "trade_date"
    vol_window: int = 60
    rel_volume_window: int = 60
    annualization: int = 252
    min_coverage: float = 1.0

    @property
    def key(self) -> list[str]:
        return [self.entity, self.date]
