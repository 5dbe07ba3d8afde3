"""Scoring of new candles as they arrive."""

from __future__ import annotations

from datetime import timedelta
from urllib.parse import quote

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.plans.model import latest_features, score
from tickloom.session import stage, temporary_stages
from tickloom.sources.tables import Tables


class StreamScorer:
    """Scores the newest candle of every symbol in a batch, once per (symbol, window, model)."""

    def __init__(self, tables: Tables, model: PipelineModel, model_id: str):
        self.tables = tables
        self.model = model
        self.model_id = model_id
        self.checkpoint = f"scoring-{quote(model_id, safe='')}"

    def start(self, available_now: bool = False) -> StreamingQuery:
        cfg = self.tables.cfg
        self.tables.bootstrap("predictions")
        writer = (
            self.tables.read_stream("gold")
            .writeStream.queryName("scoring")
            .foreachBatch(self.process)
            .option("checkpointLocation", cfg.checkpoint(self.checkpoint))
        )
        if available_now:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=cfg.processing_time).start()

    def process(self, batch: DataFrame, batch_id: int) -> None:
        with temporary_stages(self.tables.spark):
            self._process(batch, batch_id)

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        if self.tables.holds_batch("predictions", self.checkpoint, batch_id):
            return
        rows = self._latest_features(batch)
        if rows is None:
            return
        fresh = unscored(self.tables, rows, self.model_id)
        scored = score(self.model, fresh, self.tables.cfg)
        stamped = _stamped(scored, self.model_id, batch_id)
        self.tables.put_batch("predictions", stamped, self.checkpoint, batch_id)

    def _latest_features(self, batch: DataFrame) -> DataFrame | None:
        """The newest feature row of the batch's symbols, from the stored candles.

        Loads of candles older than the look-back are not opened. That changes nothing
        for a symbol with a feature row inside it; the others are computed from all their candles,
        where the join on the partition column prunes the folders of other symbols.
        """
        cfg = self.tables.cfg
        newest = batch.groupBy("symbol").agg(F.max("window_start").alias("newest"))
        touched = stage(newest, "touched")
        oldest = touched.agg(F.min("newest")).first()[0]
        if oldest is None:
            return None
        since = oldest - timedelta(seconds=cfg.score_lookback_seconds)
        candles = self.tables.read("gold")
        recent = self.tables.read("gold", since).join(touched, "symbol", "left_semi")
        found = stage(latest_features(recent, cfg), "recent")
        missing = stage(touched.join(found, "symbol", "left_anti"), "missing")
        if missing.isEmpty():
            return found
        rest = latest_features(candles.join(missing, "symbol", "left_semi"), cfg)
        return found.unionByName(rest)


def unscored(tables: Tables, rows: DataFrame, model_id: str) -> DataFrame:
    """Feature rows that have no prediction of the model yet, neither from a stream nor from a single
    run. Loads of stored predictions of earlier windows than the rows' are not opened."""
    rows = stage(rows, "to-score")
    since = rows.agg(F.min("window_start")).first()[0]
    if since is None:
        return rows
    known = tables.read("predictions", since).where(F.col("model_id") == model_id)
    return rows.join(known.select("symbol", "window_start"), ["symbol", "window_start"], "left_anti")


def append_latest(tables: Tables, model: PipelineModel, model_id: str) -> None:
    """One scoring run over the whole candle table: the newest row of every symbol, unless it has been
    scored. Single runs carry the batch number -1."""
    tables.bootstrap("predictions")
    rows = unscored(tables, latest_features(tables.read("gold"), tables.cfg), model_id)
    tables.append("predictions", _stamped(score(model, rows, tables.cfg), model_id, -1))


def _stamped(scored: DataFrame, model_id: str, batch_id: int) -> DataFrame:
    return scored.withColumns(
        {
            "predicted_at": F.current_timestamp(),
            "model_id": F.lit(model_id),
            "batch_id": F.lit(batch_id).cast("bigint"),
        }
    )
