"""Settings shared by the batch and streaming jobs."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TickConfig:
    """Paths, formats, window sizes and thresholds of one deployment.

    ``table_format`` is any Spark format that can append partitioned files (``parquet`` by
    default, ``delta`` where its jar is on the class path). ``source_options`` go to the stream
    reader unchanged, so brokers, topics and credentials stay in the deployment.
    """

    base_path: str = "lake"
    table_format: str = "parquet"

    source_format: str = "kafka"
    source_options: dict = field(default_factory=dict)
    topic: str = "stock_prices"
    starting_offsets: str = "earliest"
    # None takes everything that is there; a number caps offsets (or files) per micro-batch.
    max_per_batch: int | None = None
    # Loads of a layer table that the layer behind takes in one micro-batch; None takes all.
    max_loads_per_batch: int | None = 100
    # A compacted load of one day that is smaller takes part in the next compaction of that day.
    small_load_bytes: int = 128 << 20

    processing_time: str = "0 seconds"
    bronze_watermark: str = "1 minute"
    silver_watermark: str = "10 minutes"
    gold_watermark: str = "5 seconds"
    window: str = "10 seconds"
    slide: str | None = None

    # Bronze takes the first arrival also among rows of one batch, and stores duplicates and late rows. Off,
    # it takes any one and only counts the late ones, which is faster: the topic is read once.
    ordered_arrivals: bool = False
    # Keep undecodable messages as NULL rows instead of moving them to the reject table.
    keep_undecodable: bool = False
    max_records_per_file: int = 0

    buy_above: float = 0.55
    sell_below: float = 0.45
    train_fraction: float = 0.8
    num_trees: int = 50
    seed: int = 17
    # Partitions of the training rows; None takes the session's shuffle partitions. A seed repeats
    # its model only on the same number.
    fit_partitions: int | None = None

    # Stored candles read first when a batch is scored; older ones only for symbols that need them.
    score_lookback_seconds: int = 86400

    # Length of the time slices that ordered per-symbol calculations run on.
    tick_slice_seconds: int = 3600
    candle_slice_seconds: int = 86400
    # A slice with more rows than this is cut further.
    max_slice_rows: int = 5_000_000

    def path(self, name: str) -> str:
        return f"{self.base_path}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.base_path}/_checkpoints/{name}"
