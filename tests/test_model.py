"""Random forest: separable data, reproducibility, persistence, per-batch scoring."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.config import TickConfig
from tickloom.plans import features, forest, model
from tickloom.schemas import GOLD
from tickloom.sources.tables import Tables
from tickloom.streaming.scoring import StreamScorer, append_latest

T0 = datetime(2024, 5, 1)
CFG = TickConfig(num_trees=10, fit_partitions=4)


def alternating(spark, symbols=("A", "B"), n=200, start=0):
    data = []
    for symbol in symbols:
        for i in range(start, start + n):
            at = T0 + timedelta(minutes=i)
            price = 10.0 + i % 2
            data.append((at, at + timedelta(minutes=1), symbol, price, price, price, 0.5, 10 + i % 3, 1, 0.1, T0))
    return spark.createDataFrame(data, GOLD)


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model") / "forest")
    fitted, report = model.train_and_evaluate(alternating(spark), CFG, path)
    return fitted, report, path


def test_learns_and_reports(trained):
    _, report, _ = trained
    assert report.accuracy > 0.9
    assert (report.train_rows, report.test_rows) == (2 * 158, 2 * 40)


def test_same_model_from_shuffled_input(spark, trained):
    fitted, _, _ = trained
    again, _ = model.train_and_evaluate(alternating(spark).repartition(7, F.rand(3)), CFG)
    rows = alternating(spark)
    assert sorted(model.score_latest(fitted, rows, CFG).collect()) == sorted(
        model.score_latest(again, rows, CFG).collect()
    )


def test_saved_model_scores_the_same(spark, trained):
    fitted, _, path = trained
    rows = alternating(spark)
    scored = sorted(model.score_latest(fitted, rows, CFG).collect())
    assert scored == sorted(model.score_latest(model.load_model(path), rows, CFG).collect())
    assert [r["symbol"] for r in scored] == ["A", "B"]
    # price is up now, so it falls next
    assert {r["signal"] for r in scored} == {"SELL"}
    assert {r["window_end"] - r["window_start"] for r in scored} == {timedelta(minutes=1)}


def test_joins_with_the_nodes_score_the_same(spark, trained):
    fitted, _, path = trained
    rows = features.features(alternating(spark, n=60), CFG)
    joined = forest.probabilities(rows, forest.nodes(spark, path), forest.depth(fitted)).collect()
    scored = {(r.symbol, r.window_start): r.probability for r in model.score(fitted, rows, CFG).collect()}
    assert len(joined) == len(scored) > 100 and len({round(p, 6) for p in scored.values()}) > 1
    assert all(abs(scored[r.symbol, r.window_start] - r.probability) < 1e-12 for r in joined)
    # a forest with a node bent is found out
    bent = forest.nodes(spark, path).withColumn("stats", F.when(F.col("tree") == 0, F.reverse("stats")).otherwise(F.col("stats")))
    wrong = forest.probabilities(rows, bent, forest.depth(fitted)).collect()
    assert any(abs(scored[r.symbol, r.window_start] - r.probability) > 1e-3 for r in wrong)


def test_accuracy_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "prediction double, label double")
    assert model.accuracy(empty).first()[0] is None


def test_stream_scoring_is_idempotent(spark, trained, tmp_path):
    fitted, _, _ = trained
    tables = Tables(spark, TickConfig(base_path=str(tmp_path / "lake"), num_trees=10))
    tables.append("gold", alternating(spark, n=20))
    scorer = StreamScorer(tables, fitted, "forest-1")
    scorer.start(available_now=True).awaitTermination()
    first = sorted(tables.read("predictions").drop("predicted_at").collect())
    assert [(r["symbol"], r["batch_id"], r["model_id"]) for r in first] == [("A", 0, "forest-1"), ("B", 0, "forest-1")]
    # a replay of the batch replaces itself
    scorer.process(tables.read("gold"), 0)
    assert sorted(tables.read("predictions").drop("predicted_at").collect()) == first
    # a later batch without newer candles adds nothing
    scorer.process(tables.read("gold"), 1)
    assert tables.read("predictions").count() == 2
    # new candles of one symbol
    tables.append("gold", alternating(spark, ("B",), n=3, start=20))
    scorer.start(available_now=True).awaitTermination()
    got = tables.read("predictions").where("batch_id = 1").collect()
    assert [(r["symbol"], r["window_start"]) for r in got] == [("B", T0 + timedelta(minutes=22))]
    # another model keeps its own rows
    StreamScorer(tables, fitted, "forest-2").process(tables.read("gold"), 0)
    assert tables.read("predictions").groupBy("model_id").count().count() == 2
    # single runs and the stream see each other's predictions
    for model_id in ("manual", "forest-1"):
        append_latest(tables, fitted, model_id)
        append_latest(tables, fitted, model_id)
    scorer.process(tables.read("gold"), 2)
    predictions = tables.read("predictions")
    assert predictions.where("model_id = 'manual'").count() == 2
    assert predictions.where("model_id = 'forest-1'").count() == 3
    assert predictions.select("symbol", "window_start", "model_id").distinct().count() == predictions.count()


@pytest.mark.parametrize("lookback", [1, 86400])
def test_scoring_looks_back_as_far_as_needed(spark, trained, tmp_path, lookback):
    fitted, _, _ = trained
    cfg = TickConfig(base_path=str(tmp_path / "lake"), score_lookback_seconds=lookback)
    tables = Tables(spark, cfg)
    # B's newest candles have no return: the price was zero or the volume is unknown
    worn = alternating(spark, ("B",), n=2, start=20).withColumn("avg_price", F.lit(0.0))
    tables.append("gold", alternating(spark, n=20).unionByName(worn))
    tables.bootstrap("predictions")
    StreamScorer(tables, fitted, "m").process(tables.read("gold"), 0)
    got = tables.read("predictions").select("symbol", "window_start", "probability").collect()
    want = model.score_latest(fitted, tables.read("gold"), cfg).select("symbol", "window_start", "probability")
    assert sorted(got) == sorted(want.collect())
    assert sorted(r["window_start"] for r in got) == [T0 + timedelta(minutes=19)] * 2
