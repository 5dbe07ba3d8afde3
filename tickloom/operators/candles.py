"""Aggregation of ticks into time-window candles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import exact_mean


def candles(df: DataFrame, window: str, slide: str | None = None) -> DataFrame:
    """One row per (window, symbol), in batch and in streams.

    Every aggregate has a partial form, so a hot symbol is reduced before the shuffle. The means
    are exact sums (``exact_mean``) and so do not change with the partitioning; each tick's percent
    is rounded to ten digits for that.

    Fixed values: the names of the columns and the digits they are rounded to.
    """
    grouped = df.groupBy(F.window("timestamp", window, slide), "symbol")
    aggregated = grouped.agg(
        F.round(exact_mean("price"), 2).alias("avg_price"),
        F.round(F.min("price"), 2).alias("min_price"),
        F.round(F.max("price"), 2).alias("max_price"),
        F.round(F.coalesce(F.stddev("price"), F.lit(0.0)), 4).alias("volatility"),
        F.sum("volume").alias("total_volume"),
        F.count("*").alias("trade_count"),
        F.round(exact_mean(F.round("price_change_pct", 10), 10), 2).alias("avg_price_change_pct"),
    )
    return aggregated.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *(c for c in aggregated.columns if c != "window"),
    )
