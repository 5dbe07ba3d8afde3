"""Removal of duplicate ticks and of repeated quotes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.ordered import Slices

TICK_KEY = ("symbol", "timestamp")


def first_arrivals(
    df: DataFrame,
    watermark: str,
    keys: Sequence[str] = TICK_KEY,
    arrival: Sequence[str] = ("ingestion_timestamp",),
) -> DataFrame:
    """One row per key: the first to arrive.

    A stream keeps the keys in state until the watermark passes them and drops later rows.
    A batch ranks by ``arrival``; the limit on the rank runs before the shuffle, so a hot key
    sends at most one row per task. All other columns decide ties.
    """
    if df.isStreaming:
        return df.withWatermark("timestamp", watermark).dropDuplicates(list(keys))
    ties = [c for c in df.columns if c not in arrival and c not in keys]
    by_arrival = Window.partitionBy(*keys).orderBy(*arrival, *ties)
    return (
        df.withColumn("_arrived", F.row_number().over(by_arrival))
        .where(F.col("_arrived") == 1)
        .drop("_arrived")
    )


def without_repeats(
    df: DataFrame,
    arrival: Sequence[str],
    seconds: int,
    max_rows: int,
    key: str = "symbol",
    time: str = "timestamp",
) -> DataFrame:
    """Drop a quote whose time equals that of the symbol's previous quote (``A,A,B,A`` → ``A,B,A``).

    The first quote of a symbol is compared with nothing, that is with NULL: one without a time
    is dropped too. ``arrival`` orders the quotes and must start with a timestamp.
    """
    sliced = Slices.of_rows(df, [key], arrival, seconds, carry=[time], max_rows=max_rows)
    return (
        sliced.lag(time, "_previous_time")
        .where(~F.col(time).eqNullSafe(F.col("_previous_time")))
        .frame()
        .drop("_previous_time")
    )


def duplicate_groups(df: DataFrame, keys: Sequence[str] = TICK_KEY) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).where(F.col("count") > 1)


def worst_duplicates(df: DataFrame, n: int = 10, keys: Sequence[str] = TICK_KEY) -> DataFrame:
    """The ``n`` most repeated keys; equal counts are ordered by key."""
    order: list[Column] = [F.desc("count"), *(F.asc(k) for k in keys)]
    return duplicate_groups(df, keys).orderBy(*order).limit(n)


def duplicate_summary(df: DataFrame, keys: Sequence[str] = TICK_KEY) -> DataFrame:
    """One row: total rows, and number of keys that occur more than once."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
    )
