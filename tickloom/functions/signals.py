"""Labels derived from probabilities and candle metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and limits that results are compared on.
BUY, SELL, HOLD, WAIT = "BUY", "SELL", "HOLD", "WAIT"
BUY_ABOVE, SELL_BELOW = 0.55, 0.45
HIGH_RISK, STABLE, RISK_LIMIT = "High Risk", "Stable", 1.0
BULLISH, BEARISH = "Bullish", "Bearish"
STRONG_ABOVE = 0.6


def signal_band(probability: Column, buy_above: float = BUY_ABOVE, sell_below: float = SELL_BELOW) -> Column:
    """BUY above the upper limit, SELL below the lower one, HOLD between (limits included)."""
    return (
        F.when(probability > buy_above, BUY).when(probability < sell_below, SELL).otherwise(HOLD)
    )


def signal_or_fallback(signal: Column, probability: Column) -> Column:
    """The stored signal, or one read off the probability where none is stored."""
    stored = F.coalesce(signal, F.lit(WAIT))
    return (
        F.when(stored != WAIT, stored)
        .when(probability > 0.5, BUY)
        .when(probability > 0, SELL)
        .otherwise(WAIT)
    )


def risk_band(volatility: Column) -> Column:
    return F.when(volatility > RISK_LIMIT, HIGH_RISK).otherwise(STABLE)


def strong_prediction(probability: Column) -> Column:
    return F.coalesce(probability > STRONG_ABOVE, F.lit(False))


def trend_label(latest: Column, mean: Column) -> Column:
    return F.when(latest > mean, BULLISH).otherwise(BEARISH)
