"""Random-forest training, evaluation and scoring with ``spark.ml``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.config import TickConfig
from tickloom.functions import signal_band
from tickloom.operators.ranking import newest_with_ties
from tickloom.plans.features import FEATURE_COLUMNS, TEST, TRAIN, features, split_counts, time_split
from tickloom.session import stage, temporary_stages


@dataclass(frozen=True)
class TrainingReport:
    train_rows: int
    test_rows: int
    accuracy: float | None


def forest_pipeline(cfg: TickConfig = TickConfig()) -> Pipeline:
    assembler = VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features")
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=cfg.num_trees, seed=cfg.seed
    )
    return Pipeline(stages=[assembler, forest])


def fit(train: DataFrame, cfg: TickConfig = TickConfig()) -> PipelineModel:
    """Fit on rows laid out by (symbol, window_start).

    The bagging draws per partition, so a fixed seed repeats only on a fixed layout: hash
    partitions of a fixed number, sorted inside. Hashing the time too keeps a hot symbol spread.
    """
    shuffle_partitions = train.sparkSession.conf.get("spark.sql.shuffle.partitions")
    laid_out = (
        train.select("symbol", "window_start", *FEATURE_COLUMNS, "label")
        .repartition(cfg.fit_partitions or int(shuffle_partitions), "symbol", "window_start")
        .sortWithinPartitions("symbol", "window_start")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        return forest_pipeline(cfg).fit(laid_out)
    finally:
        laid_out.unpersist()


def accuracy(predictions: DataFrame) -> DataFrame:
    """One row: share of predictions that equal the label, NULL without predictions."""
    return predictions.agg(
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy")
    )


def train_and_evaluate(
    candles: DataFrame, cfg: TickConfig = TickConfig(), model_path: str | None = None
) -> tuple[PipelineModel, TrainingReport]:
    """Split by time, fit on the earlier part, measure on the later part, save when asked to."""
    with temporary_stages(candles.sparkSession):
        split = stage(time_split(candles, cfg), "split")
        counts = {r["split"]: r["row_count"] for r in split_counts(split).collect()}
        model = fit(split.where(F.col("split") == TRAIN), cfg)
        scored = model.transform(split.where(F.col("split") == TEST))
        report = TrainingReport(counts.get(TRAIN, 0), counts.get(TEST, 0), accuracy(scored).first()[0])
    if model_path:
        save_model(model, model_path)
    return model, report


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, feature_rows: DataFrame, cfg: TickConfig = TickConfig()) -> DataFrame:
    """Probability of a rise and the signal it stands for."""
    rise = vector_to_array("probability")[1]
    scored = model.transform(feature_rows).select(
        "symbol", "window_start", "window_end", rise.alias("probability")
    )
    return scored.withColumn(
        "signal", signal_band(F.col("probability"), cfg.buy_above, cfg.sell_below)
    )


def latest_features(candles: DataFrame, cfg: TickConfig = TickConfig()) -> DataFrame:
    """The newest feature row of every symbol."""
    return newest_with_ties(features(candles, cfg))


def score_latest(model: PipelineModel, candles: DataFrame, cfg: TickConfig = TickConfig()) -> DataFrame:
    """Signals for the newest feature row of every symbol."""
    return score(model, latest_features(candles, cfg), cfg)
