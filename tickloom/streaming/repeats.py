"""Streaming suppression of consecutive repeats per symbol.

The state is one row per symbol, the time of its last quote. It is kept as a table in two slots
that take turns: batch ``n`` reads slot ``n - 1`` and writes slot ``n``, so a replayed batch finds
the state it started from. Inside a batch the sliced operator compares neighbours, so a symbol
with most of the rows is spread over tasks, which a keyed state processor could not do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.config import TickConfig
from tickloom.operators.ordered import Slices
from tickloom.session import stage, temporary_stages

STATE = "symbol string, last_time timestamp"


class RepeatFilter:
    """``arrival`` orders the quotes and must start with a timestamp column."""

    def __init__(self, spark: SparkSession, out: str, state: str, arrival: list[str], cfg: TickConfig):
        self.spark = spark
        self.out = out
        self.state = state
        self.arrival = arrival
        self.cfg = cfg

    def start(self, quotes: DataFrame, checkpoint: str, available_now: bool = False) -> StreamingQuery:
        writer = quotes.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        if available_now:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=self.cfg.processing_time).start()

    def process(self, batch: DataFrame, batch_id: int) -> None:
        with temporary_stages(self.spark):
            self._process(batch, batch_id)

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        columns = batch.columns
        batch = stage(batch.withColumn("_row", F.lit(True)), "quotes")
        state = self._state_before(batch_id)
        sliced = Slices.of_rows(
            batch,
            ["symbol"],
            self.arrival,
            self.cfg.tick_slice_seconds,
            carry=["timestamp", "_row"],
            max_rows=self.cfg.max_slice_rows,
        )
        compared = (
            sliced.lag("timestamp", "_previous")
            .lag("_row", "_has_previous")
            .frame()
            .join(state, "symbol", "left")
        )
        previous = F.when(F.col("_has_previous"), F.col("_previous")).otherwise(F.col("last_time"))
        kept = compared.where(~F.col("timestamp").eqNullSafe(previous)).select(
            *columns, F.lit(batch_id).cast("bigint").alias("batch_id")
        )
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "batch_id"
        ).parquet(self.out)
        self._write_state(batch, state, batch_id)

    def _state_before(self, batch_id: int) -> DataFrame:
        if batch_id == 0:
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(STATE).parquet(self._slot(batch_id - 1))

    def _write_state(self, batch: DataFrame, state: DataFrame, batch_id: int) -> None:
        order = F.struct(*self.arrival)
        newest = batch.groupBy("symbol").agg(F.max_by("timestamp", order).alias("last_time"))
        untouched = state.join(newest, "symbol", "left_anti")
        newest.unionByName(untouched).write.mode("overwrite").parquet(self._slot(batch_id))

    def _slot(self, batch_id: int) -> str:
        return f"{self.state}/slot={batch_id % 2}"
