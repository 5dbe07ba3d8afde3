"""Queries over candles and predictions, for all symbols at once or for one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.config import TickConfig
from tickloom.functions import (
    exact_mean,
    risk_band,
    signal_or_fallback,
    strong_prediction,
    trend_label,
)
from tickloom.operators.ordered import Slices
from tickloom.operators.ranking import newest, top

MOVE_LIMIT, VOLATILITY_LIMIT = 1.0, 2.0
NO_PREDICTION = "WAITING"


def of_symbol(df: DataFrame, symbol: str) -> DataFrame:
    """Rows of one symbol; on the layer tables this reads one partition folder."""
    return df.where(F.col("symbol") == F.lit(symbol))


def symbols(candles: DataFrame) -> DataFrame:
    return candles.select("symbol").distinct().orderBy("symbol")


def symbol_stats(candles: DataFrame) -> DataFrame:
    """Mean price, mean volatility, volume and number of windows per symbol, most volatile first."""
    return (
        candles.groupBy("symbol")
        .agg(
            exact_mean("avg_price").alias("overall_avg_price"),
            exact_mean("volatility").alias("avg_volatility"),
            F.sum("total_volume").alias("cumulative_volume"),
            F.count("*").alias("window_count"),
        )
        .orderBy(F.desc("avg_volatility"), "symbol")
    )


def volatility_overview(candles: DataFrame) -> DataFrame:
    """Mean price, highest volatility and volume per symbol, most volatile first."""
    return (
        candles.groupBy("symbol")
        .agg(
            exact_mean("avg_price").alias("mean_price"),
            F.max("volatility").alias("max_vol"),
            F.sum("total_volume").alias("total_vol"),
        )
        .orderBy(F.desc("max_vol"), "symbol")
    )


def top_movers(candles: DataFrame, n: int = 10, limit: float = MOVE_LIMIT) -> DataFrame:
    """The ``n`` windows with the largest price change above ``limit`` percent either way."""
    moved = F.abs("avg_price_change_pct")
    picked = candles.where(moved > limit).select(
        "symbol", "window_start", "window_end", "avg_price_change_pct", "avg_price"
    )
    return top(picked, n, moved.desc(), F.asc("symbol"), F.asc("window_start"))


def volatile_windows(candles: DataFrame, limit: float = VOLATILITY_LIMIT) -> DataFrame:
    return (
        candles.where(F.col("volatility") > limit)
        .select("symbol", "window_start", "volatility", "avg_price")
        .orderBy(F.desc("volatility"), "symbol", "window_start")
    )


def latest_windows(candles: DataFrame, n: int = 100) -> DataFrame:
    """The latest ``n`` windows of every symbol."""
    return newest(candles, n, "window_end")


def latest_windows_of(candles: DataFrame, symbol: str, n: int = 100) -> DataFrame:
    return top(of_symbol(candles, symbol), n, F.desc("window_end"))


def latest_prediction(predictions: DataFrame) -> DataFrame:
    """The newest prediction of every symbol; of several for a window the last one written."""
    ties = [F.desc("predicted_at")] if "predicted_at" in predictions.columns else []
    return newest(predictions, 1, "window_end", ties).select(
        "symbol", "window_end", "probability", "signal"
    )


def session_range(candles: DataFrame) -> DataFrame:
    return candles.groupBy("symbol").agg(
        F.max("max_price").alias("session_high"), F.min("min_price").alias("session_low")
    )


def trend(candles: DataFrame, windows: int = 5) -> DataFrame:
    """Newest price against the mean of the newest ``windows`` prices (fewer where there are fewer)."""
    recent = newest(candles.select("symbol", "window_start", "avg_price"), windows, "window_start")
    return (
        recent.groupBy("symbol")
        .agg(
            F.max("window_start").alias("window_start"),
            F.max_by("avg_price", "window_start").alias("latest_price"),
            exact_mean("avg_price").alias("mean_price"),
        )
        .withColumn("trend", trend_label(F.col("latest_price"), F.col("mean_price")))
    )


def trend_series(candles: DataFrame, windows: int = 5, cfg: TickConfig = TickConfig()) -> DataFrame:
    """Every price against the mean of it and the ``windows - 1`` before it (fewer at the start of a symbol). Takes a stored
    candle table. Prices are taken to a millionth, so the mean is that of whole numbers."""
    needed = candles.select("symbol", "window_start", F.col("avg_price").alias("latest_price"))
    rolled = (
        Slices.of_steps(needed, ["symbol"], ["window_start"], cfg.candle_slice_seconds)
        .rolling("latest_price", windows, "_prices")
        .frame()
    )
    units = F.transform(F.array_compact("_prices"), lambda p: F.rint(p * 1e6).cast("decimal(38,0)"))
    total = F.aggregate(units, F.lit(0).cast("decimal(38,0)"), lambda a, x: (a + x).cast("decimal(38,0)"))
    mean = F.try_divide(total.cast("double"), F.size(units) * F.lit(1e6))
    out = rolled.select("symbol", "window_start", "latest_price", mean.alias("mean_price"))
    return out.withColumn("trend", trend_label(F.col("latest_price"), F.col("mean_price")))


def risk_flags(candles: DataFrame) -> DataFrame:
    return candles.select(
        "symbol",
        "window_start",
        "volatility",
        risk_band(F.col("volatility")).alias("risk"),
        (F.col("max_price") - F.col("min_price")).alias("window_spread"),
    )


def price_series(candles: DataFrame, cfg: TickConfig = TickConfig()) -> DataFrame:
    """Chart series: candle body at the mean price, and the rise of the volume over the previous
    window (0 on the first window and where it falls). Takes a stored candle table."""
    needed = candles.select(
        "symbol", "window_start", "window_end", "avg_price", "max_price", "min_price", "total_volume"
    )
    shifted = (
        Slices.of_steps(needed, ["symbol"], ["window_start"], cfg.candle_slice_seconds)
        .lag("total_volume", "_previous")
        .frame()
    )
    rise = F.coalesce(F.col("total_volume") - F.col("_previous"), F.lit(0))
    return shifted.select(
        "symbol",
        F.col("window_end").alias("time"),
        F.col("avg_price").alias("open"),
        F.col("max_price").alias("high"),
        F.col("min_price").alias("low"),
        F.col("avg_price").alias("close"),
        F.greatest(rise, F.lit(0)).cast("bigint").alias("volume_delta"),
    )


def price_series_of(candles: DataFrame, symbol: str, cfg: TickConfig = TickConfig()) -> DataFrame:
    """The series of one symbol in time order."""
    return price_series(of_symbol(candles, symbol), cfg).orderBy("time")


def kpi_board(candles: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row per symbol: newest candle, session range, risk, trend and newest prediction.

    Everything is reduced per symbol before a shuffle; the joins run on one row per symbol.
    """
    newest_values = [
        F.max_by(c, "window_start").alias(c)
        for c in (
            "window_end",
            "avg_price",
            "avg_price_change_pct",
            "total_volume",
            "volatility",
            "max_price",
            "min_price",
        )
    ]
    latest = candles.groupBy("symbol").agg(
        *newest_values,
        F.max("max_price").alias("session_high"),
        F.min("min_price").alias("session_low"),
    )
    signals = latest_prediction(predictions).select(
        "symbol", "probability", "signal", F.lit(True).alias("_predicted")
    )
    joined = latest.join(trend(candles).select("symbol", "trend"), "symbol").join(
        signals, "symbol", "left"
    )
    signal = F.when(
        F.col("_predicted"), signal_or_fallback(F.col("signal"), F.col("probability"))
    ).otherwise(NO_PREDICTION)
    return joined.select(
        "symbol",
        "window_end",
        F.col("avg_price").alias("price"),
        F.coalesce("avg_price_change_pct", F.lit(0.0)).alias("change_pct"),
        signal.alias("signal"),
        "probability",
        strong_prediction(F.col("probability")).alias("strong"),
        F.col("total_volume").alias("volume"),
        "volatility",
        risk_band(F.col("volatility")).alias("risk"),
        "session_high",
        "session_low",
        (F.col("max_price") - F.col("min_price")).alias("window_spread"),
        "trend",
    )
