"""Candles in parts: partial sums of short windows that merge into candles of any longer window.

A state holds what a candle is made from, not what it shows: counts, extremes, and exact sums. Sums add up, so hours from stored
states of ten seconds are the hours from the ticks, and the ticks are read once however many window lengths are asked for.

Prices are taken to a millionth (percents to ten digits) and summed as integers, and so are their squares, so the second moment is
exact, too: ``sum u^2 - (sum u)^2 / n`` is taken apart into integers before anything is divided. Prices of more than 53 bits in
millionths, and those that are no numbers, are left to means and moments in doubles, for the candles that hold one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRICE_SCALE, PERCENT_SCALE = 10**6, 10**10
#: doubles hold whole numbers up to here
_EXACT = float(1 << 53)
_WIDE = "decimal(38,0)"


def _units(x: Column, scale: int) -> Column:
    """A value as the nearest whole number of units; null if that has too many bits."""
    rounded = F.rint(x * float(scale))
    return F.when(F.abs(rounded) < _EXACT, rounded).cast("long")


def states(ticks: DataFrame, window: str) -> DataFrame:
    """One row per window and symbol, in batch and in streams. Percent changes are rounded to ten digits, as in candles."""
    price, percent = F.col("price"), F.round("price_change_pct", 10)
    price_units, percent_units = _units(price, PRICE_SCALE), _units(percent, PERCENT_SCALE)
    grouped = ticks.groupBy(F.window("timestamp", window), "symbol").agg(
        F.count("*").alias("ticks"),
        F.count("price").alias("prices"),
        F.count(price_units).alias("exact_prices"),
        F.sum(price_units.cast("decimal(16,0)")).cast(_WIDE).alias("price_sum"),
        F.sum((price_units.cast("decimal(16,0)") * price_units.cast("decimal(16,0)")).cast("decimal(32,0)")).cast(_WIDE).alias("square_sum"),
        F.avg("price").alias("price_mean"),
        (F.var_pop("price") * F.count("price")).alias("price_moment"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum("volume").alias("total_volume"),
        F.count(percent).alias("percents"),
        F.count(percent_units).alias("exact_percents"),
        F.sum(percent_units.cast("decimal(16,0)")).cast(_WIDE).alias("percent_sum"),
        F.avg(percent).alias("percent_mean"),
    )
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *(c for c in grouped.columns if c != "window")
    )


def _deviation(n: Column, total: Column, squares: Column) -> Column:
    """Sample deviation, in units, from exact sums."""
    wide = n.cast(_WIDE)
    mean = F.call_function("div", total, wide).cast(_WIDE)
    rest = (total - wide * mean).cast(_WIDE)
    whole = (squares - wide * mean * mean - 2 * mean * rest).cast("double")
    moment = whole - rest.cast("double") * rest.cast("double") / n
    return F.when(n > 1, F.sqrt(F.greatest(moment, F.lit(0.0)) / (n - 1))).otherwise(F.lit(0.0))


def candles_of(parts: DataFrame, window: str, slide: str | None = None) -> DataFrame:
    """Candles of windows that are whole numbers of the states' windows."""
    n = F.col("prices")
    mean = F.sum(F.col("price_mean") * n) / F.sum(n)
    grouped = parts.groupBy(F.window("window_start", window, slide), "symbol").agg(
        F.sum("prices").alias("prices"),
        F.sum("exact_prices").alias("exact_prices"),
        F.sum("price_sum").cast(_WIDE).alias("price_sum"),
        F.sum("square_sum").cast(_WIDE).alias("square_sum"),
        mean.alias("price_mean"),
        # the parts' own moments, and those of their means
        (F.sum("price_moment") + F.sum(n * F.col("price_mean") * F.col("price_mean"))).alias("raw_moment"),
        F.min("min_price").alias("min_price"),
        F.max("max_price").alias("max_price"),
        F.sum("total_volume").alias("total_volume"),
        F.sum("ticks").alias("trade_count"),
        F.sum("percents").alias("percents"),
        F.sum("exact_percents").alias("exact_percents"),
        F.sum("percent_sum").cast(_WIDE).alias("percent_sum"),
        (F.sum(F.col("percent_mean") * F.col("percents")) / F.sum("percents")).alias("percent_mean"),
    )
    exact_price = F.col("exact_prices") == n
    price = F.when(exact_price, F.col("price_sum").cast("double") / (n * F.lit(float(PRICE_SCALE)))).otherwise(F.col("price_mean"))
    moment = F.greatest(F.col("raw_moment") - n * F.col("price_mean") * F.col("price_mean"), F.lit(0.0))
    inexact = F.when(n > 1, F.sqrt(moment / (n - 1))).otherwise(F.lit(0.0))
    deviation = F.when(exact_price, _deviation(n, F.col("price_sum"), F.col("square_sum")) / float(PRICE_SCALE)).otherwise(inexact)
    percent = F.when(
        F.col("exact_percents") == F.col("percents"), F.col("percent_sum").cast("double") / (F.col("percents") * F.lit(float(PERCENT_SCALE)))
    ).otherwise(F.col("percent_mean"))
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "symbol",
        F.when(n > 0, F.round(price, 2)).alias("avg_price"),
        F.round("min_price", 2).alias("min_price"),
        F.round("max_price", 2).alias("max_price"),
        F.round(F.coalesce(F.when(n > 0, deviation), F.lit(0.0)), 4).alias("volatility"),
        "total_volume",
        "trade_count",
        F.when(F.col("percents") > 0, F.round(percent, 2)).alias("avg_price_change_pct"),
    )
