"""The three layers as DataFrame functions; the same ones serve batch jobs and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.config import TickConfig
from tickloom.functions import (
    fields_once,
    is_anomaly,
    price_change,
    price_change_pct,
    spread,
    to_event_time,
)
from tickloom.operators.arrivals import judged, with_news
from tickloom.operators.candle_states import states
from tickloom.operators.candles import candles
from tickloom.operators.dedup import TICK_KEY, first_arrivals
from tickloom.schemas import TICK

ARRIVAL = ("ingestion_timestamp",)


def decode(raw: DataFrame) -> DataFrame:
    """JSON messages to typed ticks. The broker's time becomes ``ingestion_timestamp``; ``value``
    and ``reason`` (NULL for a usable tick) stay for the reject table."""
    text = raw.select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("ingestion_timestamp"),
    )
    record = text.select(fields_once(F.from_json("value", TICK)), "ingestion_timestamp", "value")
    reason = (
        F.when(F.col("symbol").isNotNull() & F.col("timestamp").isNotNull(), F.lit(None))
        .when(F.get_json_object("value", "$").isNull(), "not_json")
        .when(F.col("symbol").isNull(), "no_symbol")
        .otherwise("no_timestamp")
    )
    return record.withColumn("reason", reason)


def usable_ticks(decoded: DataFrame, cfg: TickConfig = TickConfig()) -> DataFrame:
    kept = decoded if cfg.keep_undecodable else decoded.where(F.col("reason").isNull())
    return kept.drop("value", "reason")


def rejected_messages(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNotNull()).select("value", "ingestion_timestamp", "reason")


def bronze(
    ticks: DataFrame, cfg: TickConfig = TickConfig(), arrival: Sequence[str] = ARRIVAL, stamp: bool = True
) -> DataFrame:
    """First arrival per (symbol, timestamp), with the load time when ``stamp`` is set."""
    if stamp:
        ticks = ticks.withColumn("bronze_inserted_at", F.current_timestamp())
    return first_arrivals(ticks, cfg.bronze_watermark, arrival=arrival)


def bronze_news(ticks: DataFrame, cfg: TickConfig = TickConfig()) -> DataFrame:
    """All ticks of a stream, and the keys that are new; ``bronze_outcomes`` judges batches of it."""
    stamped = ticks.withColumn("bronze_inserted_at", F.current_timestamp())
    return with_news(stamped, cfg.bronze_watermark, TICK_KEY)


def bronze_outcomes(batch: DataFrame, ended: int, behind: int, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """All ticks of a batch of ``bronze_news`` with their ``outcome``: kept as ``bronze`` would, late, or a duplicate."""
    return judged(batch, ended, behind, TICK_KEY, arrival)


def enrich(ticks: DataFrame) -> DataFrame:
    """Typed event time, spread, price change (absolute and percent) and the anomaly flag."""
    event_type = dict(ticks.dtypes)["timestamp"]
    typed = ticks.withColumn("timestamp", to_event_time("timestamp", event_type))
    return typed.withColumns(
        {
            "spread": spread(),
            "price_change": price_change(),
            "price_change_pct": price_change_pct(),
            "is_anomaly": is_anomaly(),
        }
    )


def silver(
    ticks: DataFrame, cfg: TickConfig = TickConfig(), arrival: Sequence[str] = ARRIVAL, stamp: bool = True
) -> DataFrame:
    """Enriched ticks, again one per (symbol, timestamp): bronze may have been replayed."""
    enriched = enrich(ticks)
    if stamp:
        enriched = enriched.withColumn("silver_processed_at", F.current_timestamp())
    return first_arrivals(enriched, cfg.silver_watermark, arrival=arrival)


def gold_states(ticks: DataFrame, cfg: TickConfig = TickConfig()) -> DataFrame:
    """The parts of candles over the ticks that are not anomalous, per ``cfg.window``; ``candles_of`` merges them."""
    normal = ticks.where(~F.col("is_anomaly"))
    if normal.isStreaming:
        normal = normal.withWatermark("timestamp", cfg.gold_watermark)
    return states(normal, cfg.window)


def gold(ticks: DataFrame, cfg: TickConfig = TickConfig(), stamp: bool = True) -> DataFrame:
    """Candles over the ticks that are not anomalous."""
    normal = ticks.where(~F.col("is_anomaly"))
    if normal.isStreaming:
        normal = normal.withWatermark("timestamp", cfg.gold_watermark)
    out = candles(normal, cfg.window, cfg.slide)
    return out.withColumn("gold_computed_at", F.current_timestamp()) if stamp else out
