"""Ticks read from an ``events`` table (event id, time, type, value, JSON properties)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.config import TickConfig
from tickloom.operators.ordered import Slices

# Which events become faulty ticks.
ZERO_PRICE_EVERY, CROSSED_EVERY = 89, 97


def ticks_from_events(spark: SparkSession, folder: str, cfg: TickConfig = TickConfig()) -> DataFrame:
    """One tick per event: the type is the symbol, the value its price, the previous price of the
    symbol its opening; every 89th price is zero and every 97th tick has high and low crossed."""
    events = spark.read.parquet(f"{folder}/events.parquet").select(
        "event_id",
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("ingestion_timestamp"),
        F.when(F.col("event_id") % ZERO_PRICE_EVERY == 0, 0.0).otherwise(F.col("value")).alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
    )
    opened = (
        Slices.of_rows(
            events,
            keys=["symbol"],
            order=["ingestion_timestamp", "event_id"],
            seconds=cfg.tick_slice_seconds,
            carry=["price"],
            max_rows=cfg.max_slice_rows,
        )
        .lag("price", "_previous")
        .frame()
        .withColumn("open", F.coalesce("_previous", "price"))
    )
    upper, lower = F.greatest("price", "open"), F.least("price", "open")
    crossed = F.col("event_id") % CROSSED_EVERY == 0
    return opened.select(
        "event_id",
        "symbol",
        "price",
        "open",
        F.when(crossed, lower - 1).otherwise(upper).alias("high"),
        F.when(crossed, upper).otherwise(lower).alias("low"),
        "volume",
        F.date_trunc("minute", "ingestion_timestamp").alias("timestamp"),
        "ingestion_timestamp",
    )
