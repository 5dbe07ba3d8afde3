"""Market-tick analytics on Spark: layered tables, candles, features, signals and serving queries."""

from tickloom.config import TickConfig

__all__ = ["TickConfig"]
