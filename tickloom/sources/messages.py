"""Tick messages: JSON text in the columns of a Kafka topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.config import TickConfig
from tickloom.schemas import RAW_MESSAGE


def message_stream(spark: SparkSession, cfg: TickConfig) -> DataFrame:
    """The message source as a stream with at least ``value`` and ``timestamp``.

    Kafka is read from the configured offsets; any other format is read as files that hold those
    two columns, from ``source_options["path"]``.
    """
    reader = spark.readStream.format(cfg.source_format)
    if cfg.source_format == "kafka":
        reader = reader.options(
            subscribe=cfg.topic, startingOffsets=cfg.starting_offsets, failOnDataLoss="false"
        )
        cap = "maxOffsetsPerTrigger"
    else:
        reader = reader.schema(RAW_MESSAGE)
        cap = "maxFilesPerTrigger"
    if cfg.max_per_batch:
        reader = reader.option(cap, cfg.max_per_batch)
    return reader.options(**cfg.source_options).load()


def as_messages(rows: DataFrame, event_time: str = "timestamp", broker_time: str | None = None) -> DataFrame:
    """Rows as messages: ``key`` is the symbol, ``value`` the row in JSON with the event time in
    epoch seconds, ``timestamp`` the broker's time (now, unless a column of the rows gives it)."""
    fields = [c for c in rows.columns if c not in (event_time, broker_time)]
    body = F.struct(*fields, F.unix_seconds(event_time).alias("timestamp"))
    at = F.col(broker_time) if broker_time else F.current_timestamp()
    return rows.select(
        F.col("symbol").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
        at.alias("timestamp"),
    )


def publish(messages: DataFrame, fmt: str, options: dict) -> None:
    """Send a batch of messages to a topic, or to files (``options["path"]``)."""
    if fmt == "kafka":
        messages.select("key", "value").write.format("kafka").options(**options).save()
    else:
        messages.select("value", "timestamp").write.format(fmt).mode("append").options(**options).save()


def publish_stream(messages: DataFrame, fmt: str, options: dict, checkpoint: str) -> StreamingQuery:
    """The same for a stream of rows."""
    columns = ["key", "value"] if fmt == "kafka" else ["value", "timestamp"]
    writer = messages.select(*columns).writeStream.format(fmt).options(**options)
    return writer.option("checkpointLocation", checkpoint).start()
