"""barloom: panel analytics over daily price and volume bars, as Spark DataFrame plans."""

from barloom.spec import PanelSpec
from barloom.settings import Settings

__all__ = ["PanelSpec", "Settings"]
