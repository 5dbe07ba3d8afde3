"""Features, labels and the time-ordered split, on candles."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.config import TickConfig
from tickloom.operators.ordered import Slices

FEATURE_COLUMNS = ["log_returns", "volatility", "log_volume"]
TRAIN, TEST = "train", "test"


def features(candles: DataFrame, cfg: TickConfig = TickConfig()) -> DataFrame:
    """Candles with ``prev_price``, ``log_returns`` and ``log_volume``; rows without them dropped.

    Takes a stored candle table: slice borders are read in a second scan.
    """
    return _features(candles, cfg).frame()


def labelled(candles: DataFrame, cfg: TickConfig = TickConfig()) -> DataFrame:
    """Features plus ``next_price`` and ``label`` (1.0 where the price rises next, else 0.0). Rows
    with a NULL or NaN anywhere go, which includes each symbol's last row."""
    return _labelled(candles, cfg).drop("rank")


def time_split(candles: DataFrame, cfg: TickConfig = TickConfig()) -> DataFrame:
    """Labelled rows with ``rank`` (share of the symbol's time line) and ``split``."""
    side = F.when(F.col("rank") <= cfg.train_fraction, TRAIN).otherwise(TEST)
    return _labelled(candles, cfg).withColumn("split", side)


def split_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count("*").alias("row_count"))


def _features(candles: DataFrame, cfg: TickConfig) -> Slices:
    cut = Slices.of_steps(candles, ["symbol"], ["window_start"], cfg.candle_slice_seconds)
    derived = cut.lag("avg_price", "prev_price").with_columns(
        {
            "log_returns": F.ln(F.try_divide("avg_price", "prev_price")),
            "log_volume": F.ln(F.col("total_volume") + 1.0),
            "volatility": F.coalesce("volatility", F.lit(0.0)),
        }
    )
    return derived.where(_present(derived, ["log_returns", "log_volume", "avg_price"]))


def _labelled(candles: DataFrame, cfg: TickConfig) -> DataFrame:
    rows = _features(candles, cfg)
    complete = _present(rows, rows.columns)
    ahead = rows.lead_and_share("avg_price", "next_price", complete, "rank").frame()
    rises = F.col("next_price") > F.col("avg_price")
    return ahead.withColumn("label", F.when(rises, 1.0).otherwise(0.0))


def _present(cut: Slices, columns: Iterable[str]) -> Column:
    """No NULL, and no NaN in a floating column, among ``columns``."""
    types = dict(cut.dtypes)
    condition = F.lit(True)
    for name in columns:
        condition &= F.col(name).isNotNull()
        if types[name] in ("double", "float"):
            condition &= ~F.isnan(name)
    return condition
