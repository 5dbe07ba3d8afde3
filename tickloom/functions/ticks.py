"""Column expressions on one tick."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def spread(high: str = "high", low: str = "low") -> Column:
    return F.col(high) - F.col(low)


def price_change(price: str = "price", opening: str = "open") -> Column:
    return F.col(price) - F.col(opening)


def price_change_pct(price: str = "price", opening: str = "open") -> Column:
    """Change in percent of the opening price; 0.0 where that is NULL, zero or negative."""
    moved = F.try_divide(price_change(price, opening), F.col(opening)) * 100
    return F.when(F.col(opening) > 0, moved).otherwise(F.lit(0.0))


def is_anomaly() -> Column:
    """No volume, a price or opening that is not positive, or crossed high and low.

    A NULL outcome of the whole test counts as normal.
    """
    suspicious = (
        (F.col("volume") == 0)
        | (F.col("price") <= 0)
        | (F.col("open") <= 0)
        | (F.col("high") < F.col("low"))
    )
    return F.coalesce(suspicious, F.lit(False))


def to_event_time(column: str, dtype: str) -> Column:
    """Event time as TIMESTAMP; text that is no time becomes NULL."""
    if dtype == "timestamp":
        return F.col(column)
    if dtype == "string":
        return F.try_to_timestamp(F.col(column))
    return F.col(column).cast("timestamp")
