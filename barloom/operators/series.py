"""How to split long series, for callers who ask for it.

A per-entity window puts one entity's whole series into one task. A series has at most one row per day, so that is a few
thousand rows for decades of daily bars, and one shuffle by entity is the cheapest plan: the refresh always takes it. An
explicit ``SeriesSplit`` cuts a panel of another kind into blocks of days, with the same rows as result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.spec import PanelSpec


@dataclass(frozen=True)
class SeriesSplit:
    """``block_days`` bounds the rows of a block of calendar days, ``chunk_rows`` those of a run of like rows."""

    block_days: int = 4096
    chunk_rows: int = 8192

    def block(self, spec: PanelSpec) -> Column:
        return F.floor(F.unix_date(spec.date) / self.block_days)

