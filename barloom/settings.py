"""Run settings: catalog and schema names, landing location, the entity universe, measure parameters."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field, replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from barloom.session import local_rows
from barloom.spec import PanelSpec

PLAIN_NAME = re.compile(r"[A-Za-z_]\w*", re.ASCII)
LAYERS = ("bronze", "silver", "gold", "ops")

# The landed CSV header, in order.
SOURCE_COLUMNS = ("Date", "open", "high", "low", "close", "adjclose", "volume", "ingested_at_utc")

UNIVERSE_SCHEMA = "ticker STRING, source_symbol STRING, folder STRING, bank_name STRING, short_name STRING"


@dataclass(frozen=True)
class Settings:
    """Everything a run needs to know. ``universe`` is a list of dicts, or the path of a Parquet table with the columns
    of ``UNIVERSE_SCHEMA`` when there are too many entities for a settings file."""

    warehouse: str
    landing_path: str
    universe: list[dict] | str = field(default_factory=list)
    catalog: str = "spark_catalog"
    schemas: dict[str, str] = field(default_factory=lambda: {layer: layer for layer in LAYERS})
    source_columns: tuple[str, ...] = SOURCE_COLUMNS
    daily_glob: str = "*/*.csv"
    summary_glob: str = "*/run-summary.json"
    panel: PanelSpec = PanelSpec()

    def __post_init__(self):
        for name in (self.catalog, *self.schemas.values()):
            if not PLAIN_NAME.fullmatch(name):
                raise ValueError(f"not a plain SQL name: {name!r}")

    @classmethod
    def load(cls, path: str, warehouse: str, catalog: str = "", landing_path: str = "") -> "Settings":
        """Read a settings file; a non-blank ``catalog`` or ``landing_path`` wins over the file."""
        raw = json.loads(Path(path).read_text(encoding="utf-8"))
        kpi = raw.get("kpi", {})
        panel = PanelSpec(
            vol_window=kpi.get("vol_window", PanelSpec.vol_window),
            rel_volume_window=kpi.get("rel_volume_window", PanelSpec.rel_volume_window),
            annualization=kpi.get("annualization_factor", PanelSpec.annualization),
            min_coverage=kpi.get("min_coverage", PanelSpec.min_coverage),
        )
        chosen = cls(
            warehouse=warehouse,
            landing_path=landing_path.strip() or raw["landing_path"],
            universe=raw.get("tickers", raw.get("universe", [])),
            catalog=catalog.strip() or raw["catalog"],
            schemas=raw["schemas"],
            source_columns=tuple(raw.get("source_columns", SOURCE_COLUMNS)),
            panel=panel,
        )
        globs = {key: raw[key] for key in ("daily_glob", "summary_glob") if key in raw}
        return replace(chosen, **globs)

    def table(self, layer: str, name: str) -> str:
        """``catalog.schema.name`` of a table."""
        try:
            return ".".join((self.catalog, self.schemas[layer], name))
        except KeyError:
            raise KeyError(f"no layer {layer!r}; the layers are {sorted(self.schemas)}") from None

    def landed(self, glob: str) -> str:
        return f"{self.landing_path.rstrip('/')}/{glob}"

    def entities(self, spark: SparkSession) -> DataFrame:
        """The universe as a DataFrame. It grows with the panel and carries no hint: the planner knows its exact size, as
        a local relation or by its files, and broadcasts it only below its threshold."""
        if isinstance(self.universe, str):
            return spark.read.schema(UNIVERSE_SCHEMA).parquet(self.universe)
        columns = [c.split()[0] for c in UNIVERSE_SCHEMA.split(", ")]
        return local_rows(spark, [tuple(entry.get(c) for c in columns) for entry in self.universe], UNIVERSE_SCHEMA)
