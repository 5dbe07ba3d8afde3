"""Normalisation of the two kinds of quote payload (JSON text) into tick columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from tickloom.functions import fields_once, once

# The time format inside a series, and the name its ticks carry as their source.
SERIES_TIME = "yyyy-MM-dd HH:mm:ss"
SERIES_SOURCE = "alpha_vantage"


def ticks_from_series(
    df: DataFrame,
    payload: str = "payload",
    symbol: str = "symbol",
    interval: str = "1min",
    source: str = SERIES_SOURCE,
) -> DataFrame:
    """The newest entry of ``Time Series (<interval>)``. Payloads without a series, or whose newest
    entry lacks a field or holds text that is no number or time, give no row."""
    name = f"Time Series ({interval})"
    entries = MapType(StringType(), MapType(StringType(), StringType()))
    # the other parts of a payload are passed over by the parser
    series = F.from_json(payload, StructType([StructField(name, entries)])).getField(name)
    newest = df.select(F.col(symbol).alias("symbol"), once(series).alias("_series")).select(
        "symbol", "_series", F.array_max(F.map_keys("_series")).alias("_time")
    )
    entry = newest.select("symbol", "_time", F.try_element_at("_series", F.col("_time")).alias("_entry"))

    def field(name: str, kind: str) -> Column:
        return F.try_element_at("_entry", F.lit(name)).try_cast(kind)

    record = F.struct(
        field("4. close", "double").alias("price"),
        field("1. open", "double").alias("open"),
        field("2. high", "double").alias("high"),
        field("3. low", "double").alias("low"),
        field("5. volume", "bigint").alias("volume"),
        F.try_to_timestamp("_time", F.lit(SERIES_TIME)).alias("timestamp"),
    )
    ticks = entry.select("symbol", fields_once(record), F.lit(source).alias("source"))
    return ticks.na.drop(subset=["price", "open", "high", "low", "volume", "timestamp"])


def ticks_from_quotes(df: DataFrame, payload: str = "payload", symbol: str = "symbol") -> DataFrame:
    """One tick per quote. A number that is absent, NULL, empty or zero is 0; the volume is the
    first of two fields that is not. An absent currency is ``USD`` and an absent exchange
    ``UNKNOWN``, but one that is present and NULL stays NULL. A payload that is not JSON, or with
    text where a number belongs, gives no row."""
    quotes = df.select(
        F.col(symbol).alias("symbol"),
        once(F.from_json(payload, "map<string,string>")).alias("_quote"),
    ).where(F.col("_quote").isNotNull())

    def text(name: str) -> Column:
        return F.try_element_at("_quote", F.lit(name))

    def number(name: str) -> Column:
        return F.coalesce(F.nullif(text(name).try_cast("double"), F.lit(0.0)), F.lit(0.0))

    def whole(name: str) -> Column:
        exact = F.coalesce(text(name).try_cast("bigint"), text(name).try_cast("double").try_cast("bigint"))
        return F.nullif(exact, F.lit(0).cast("bigint"))

    def default(name: str, value: str) -> Column:
        return F.when(F.map_contains_key("_quote", name), text(name)).otherwise(value)

    numeric = (
        "currentPrice",
        "open",
        "dayHigh",
        "dayLow",
        "regularMarketVolume",
        "volume",
        "marketCap",
    )
    readable = F.lit(True)
    for name in numeric:
        empty = F.coalesce(text(name), F.lit("")) == ""
        readable &= empty | text(name).try_cast("double").isNotNull()
    at = text("regularMarketTime")
    return quotes.where(readable).select(
        "symbol",
        default("currency", "USD").alias("currency"),
        default("exchange", "UNKNOWN").alias("exchange"),
        number("currentPrice").alias("price"),
        number("open").alias("open"),
        number("dayHigh").alias("high"),
        number("dayLow").alias("low"),
        F.coalesce(whole("regularMarketVolume"), whole("volume"), F.lit(0)).alias("volume"),
        F.coalesce(whole("marketCap"), F.lit(0)).alias("market_cap"),
        F.coalesce(F.timestamp_seconds(at.try_cast("bigint")), F.try_to_timestamp(at)).alias("timestamp"),
    )
