"""The layered pipeline: one checkpointed query per layer, connected through the stored tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.config import TickConfig
from tickloom.operators.arrivals import DUPLICATE, LATE, OUTCOME
from tickloom.plans import layers
from tickloom.sources.messages import message_stream
from tickloom.sources.tables import Tables

LAYERS = ("bronze", "silver", "gold")
REJECTS = "rejects"
#: runs only where it is asked for
STATES = "states"


class LayeredPipeline:
    def __init__(self, spark: SparkSession, cfg: TickConfig):
        self.spark = spark
        self.cfg = cfg
        self.tables = Tables(spark, cfg)
        self.queries: dict[str, StreamingQuery] = {}

    def frame(self, layer: str) -> DataFrame:
        """Read and transform of one layer."""
        if layer == "bronze":
            ticks = layers.usable_ticks(layers.decode(message_stream(self.spark, self.cfg)), self.cfg)
            return layers.bronze_news(ticks, self.cfg) if self.aside(layer) else layers.bronze(ticks, self.cfg)
        if layer == REJECTS:
            return layers.rejected_messages(layers.decode(message_stream(self.spark, self.cfg)))
        if layer == "silver":
            return layers.silver(self.tables.read_stream("bronze"), self.cfg)
        if layer == STATES:
            return layers.gold_states(self.tables.read_stream("silver"), self.cfg)
        return layers.gold(self.tables.read_stream("silver"), self.cfg)

    def aside(self, layer: str) -> dict[str, Column]:
        """Tables for rows that a layer does not take."""
        if layer != "bronze" or not self.cfg.ordered_arrivals or self.cfg.table_format == "delta":
            return {}
        return {"late": F.col(OUTCOME) == LATE, "duplicates": F.col(OUTCOME) == DUPLICATE}

    def outcomes(self, layer: str, batch: DataFrame, batch_id: int) -> DataFrame:
        """The rows of a batch, told apart for the tables of ``aside``."""
        return layers.bronze_outcomes(batch, *self.tables.watermarks(layer, batch_id))

    @property
    def layer_names(self) -> tuple[str, ...]:
        return LAYERS if self.cfg.keep_undecodable else (*LAYERS, REJECTS)

    def run_layer(self, layer: str, available_now: bool = False) -> StreamingQuery:
        aside = self.aside(layer)
        for name in (layer, *aside):
            self.tables.bootstrap(name)
        query = self.tables.start_stream(layer, self.frame(layer), available_now, aside, partial(self.outcomes, layer))
        self.queries[layer] = query
        return query

    def run_continuously(self) -> None:
        """Start every layer and wait until one of them ends; then stop the others. The error of a
        layer that failed is raised."""
        try:
            for layer in self.layer_names:
                self.run_layer(layer)
            # only the pipeline's own queries: others of the session may end as they like
            while all(query.isActive for query in self.queries.values()):
                next(iter(self.queries.values())).awaitTermination(1)
            for query in self.queries.values():
                if not query.isActive:
                    query.awaitTermination()
        except KeyboardInterrupt:
            pass
        finally:
            self.stop()

    def run_available(self) -> None:
        """Work off what is there, layer after layer, and end. Rejects run beside the layers."""
        try:
            if REJECTS in self.layer_names:
                self.run_layer(REJECTS, available_now=True)
            for layer in LAYERS:
                self.run_layer(layer, available_now=True).awaitTermination()
            for query in self.queries.values():
                query.awaitTermination()
        finally:
            self.stop()

    def stop(self) -> None:
        for query in self.queries.values():
            if query.isActive:
                query.stop()
