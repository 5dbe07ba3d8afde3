"""Declared schema of every table; readers never infer."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT, NUMBER, WHOLE, TIME, FLAG = StringType(), DoubleType(), LongType(), TimestampType(), BooleanType()


def _table(base: StructType | None = None, **columns: DataType) -> StructType:
    fields = list(base.fields) if base else []
    return StructType(fields + [StructField(name, kind) for name, kind in columns.items()])


RAW_MESSAGE = _table(value=TEXT, timestamp=TIME)
TICK = _table(
    symbol=TEXT, price=NUMBER, open=NUMBER, high=NUMBER, low=NUMBER, volume=WHOLE, timestamp=TIME
)
BRONZE = _table(TICK, ingestion_timestamp=TIME, bronze_inserted_at=TIME)
SILVER = _table(
    BRONZE,
    spread=NUMBER,
    price_change=NUMBER,
    price_change_pct=NUMBER,
    is_anomaly=FLAG,
    silver_processed_at=TIME,
)
GOLD = _table(
    window_start=TIME,
    window_end=TIME,
    symbol=TEXT,
    avg_price=NUMBER,
    min_price=NUMBER,
    max_price=NUMBER,
    volatility=NUMBER,
    total_volume=WHOLE,
    trade_count=WHOLE,
    avg_price_change_pct=NUMBER,
    gold_computed_at=TIME,
)
WIDE = DecimalType(38, 0)
STATES = _table(
    window_start=TIME,
    window_end=TIME,
    symbol=TEXT,
    ticks=WHOLE,
    prices=WHOLE,
    exact_prices=WHOLE,
    price_sum=WIDE,
    square_sum=WIDE,
    price_mean=NUMBER,
    price_moment=NUMBER,
    min_price=NUMBER,
    max_price=NUMBER,
    total_volume=WHOLE,
    percents=WHOLE,
    exact_percents=WHOLE,
    percent_sum=WIDE,
    percent_mean=NUMBER,
)
PREDICTIONS = _table(
    symbol=TEXT,
    window_start=TIME,
    window_end=TIME,
    probability=NUMBER,
    signal=TEXT,
    predicted_at=TIME,
    model_id=TEXT,
    batch_id=WHOLE,
)
REJECTS = _table(value=TEXT, ingestion_timestamp=TIME, reason=TEXT)

# rows that bronze does not take: behind its watermark, or not the first of their key
LATE = DUPLICATES = BRONZE

TABLES = {
    "bronze": BRONZE,
    "silver": SILVER,
    "gold": GOLD,
    "states": STATES,
    "predictions": PREDICTIONS,
    "rejects": REJECTS,
    "late": LATE,
    "duplicates": DUPLICATES,
}
PARTITION_COLUMNS = {
    "bronze": ["symbol"],
    "silver": ["symbol"],
    "gold": ["symbol"],
    "states": ["symbol"],
    "predictions": ["model_id"],
    "rejects": [],
    "late": ["symbol"],
    "duplicates": ["symbol"],
}
#: event time of each table, by which loads know their range
TIME_COLUMNS = {
    "bronze": "timestamp",
    "silver": "timestamp",
    "gold": "window_start",
    "states": "window_start",
    "predictions": "window_start",
    "rejects": "ingestion_timestamp",
    "late": "timestamp",
    "duplicates": "timestamp",
}
