"""What became of every published message."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.config import TickConfig
from tickloom.sources.tables import Tables


def ticks_behind_candles(silver: DataFrame, gold: DataFrame, cfg: TickConfig) -> DataFrame:
    """Ticks that no stored candle counts although their window is closed: they came behind gold's watermark. With ``closed`` false:
    ticks whose window is still open.

    A candle counts the ticks of whole silver batches, the earliest ones, up to its number of trades. Ticks are counted per window
    and batch first, so a busy window is a few rows. For tumbling windows, and after the streams have come to rest.
    """
    if cfg.slide:
        raise ValueError("a tick in several windows may be late for some of them")
    span = F.window("timestamp", cfg.window)
    normal = silver.where(~F.col("is_anomaly")).withColumn("_span", span)
    batch = ["symbol", "_span", "silver_processed_at"]
    so_far = Window.partitionBy("symbol", "_span").orderBy("silver_processed_at")
    sums = normal.groupBy(*batch).agg(F.count("*").alias("_n")).withColumn("_until", F.sum("_n").over(so_far))
    counted = gold.select("symbol", F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")).alias("_span"), "trade_count")
    watermark = silver.agg(F.max("timestamp").alias("_newest"))
    missed = (
        sums.join(counted, ["symbol", "_span"], "left")
        .where(F.coalesce(F.col("_until") > F.col("trade_count"), F.lit(True)))
        # one row
        .crossJoin(F.broadcast(watermark))
        .withColumn("closed", F.col("trade_count").isNotNull() | (F.col("_span.end") <= F.col("_newest") - F.expr(f"INTERVAL {cfg.gold_watermark}")))
        .select(*batch, "closed")
    )
    return normal.join(missed, batch).drop("_span")


def balance(tables: Tables) -> DataFrame:
    """``outcome, messages``: every message the layers took from the topic, by what became of it."""
    cfg = tables.cfg
    silver, gold = tables.read("silver"), tables.read("gold")
    behind = ticks_behind_candles(silver, gold, cfg)

    def count(rows: DataFrame, outcome: str) -> DataFrame:
        return rows.agg(F.count("*").alias("messages")).select(F.lit(outcome).alias("outcome"), "messages")

    parts = [
        gold.agg(F.coalesce(F.sum("trade_count"), F.lit(0)).alias("messages")).select(F.lit("candles").alias("outcome"), "messages"),
        count(behind.where("closed"), "late for candles"),
        count(behind.where("NOT closed"), "open windows"),
        count(silver.where("is_anomaly"), "anomalies"),
        *(count(tables.read(name), name) for name in ("late", "duplicates", "rejects") if tables.exists(name)),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
