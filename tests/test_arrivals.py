"""First arrivals in streams: order inside a batch, late rows, duplicates, and the balance of all messages."""

import json
from dataclasses import replace
from datetime import datetime, timezone

import pytest

from tickloom.config import TickConfig
from tickloom.plans import audit, layers
from tickloom.streaming.pipeline import LayeredPipeline
from tests.test_streaming import EPOCH, FAR, Topic, message, prices


class TimedTopic(Topic):
    """Messages with arrival times of their own, in one file."""

    def send_at(self, *timed):
        lines = [json.dumps({"value": t, "timestamp": datetime.fromtimestamp(EPOCH + s, timezone.utc).isoformat()}) for s, t in timed]
        self.send(message("unused", 0))
        (self.folder / f"{self.files - 1:05}.json").write_text("\n".join(lines))


@pytest.fixture
def topic(tmp_path):
    return TimedTopic(tmp_path / "topic")


@pytest.fixture
def cfg(tmp_path, topic):
    return TickConfig(
        base_path=str(tmp_path / "lake"),
        source_format="json",
        source_options={"path": str(topic.folder)},
        max_per_batch=1,
        ordered_arrivals=True,
    )


def run_bronze(spark, cfg):
    pipeline = LayeredPipeline(spark, cfg)
    query = pipeline.run_layer("bronze", available_now=True)
    query.awaitTermination()
    return pipeline, query


def test_conflicts_in_one_batch_give_the_batch_result(spark, topic, cfg):
    topic.send_at(
        *((s, message("A", 0, price)) for s, price in ((3, 30.0), (1, 11.0), (2, 20.0))),
        *((5, message("B", 0, price)) for price in (7.0, 6.0, 8.0)),
        (9, message("C", 0)),
    )
    topic.send_at((0, message("A", 0, 1.0)), (4, message("C", 0)), (4, message("C", 1)))
    pipeline, _ = run_bronze(spark, cfg)
    assert prices(pipeline, "bronze") == [("A", 0, 11.0), ("B", 0, 6.0), ("C", 0, 10.0), ("C", 1, 10.0)]
    assert prices(pipeline, "duplicates") == [("A", 0, 1.0), ("A", 0, 20.0), ("A", 0, 30.0), ("B", 0, 7.0), ("B", 0, 8.0), ("C", 0, 10.0)]
    raw = spark.read.schema("value string, timestamp timestamp").json(str(topic.folder / "00000.json"))
    batch = layers.bronze(layers.usable_ticks(layers.decode(raw)), stamp=False)
    assert sorted((r.symbol, r.price) for r in batch.collect()) == [("A", 11.0), ("B", 6.0), ("C", 10.0)]


def test_state_ends_at_the_watermark(spark, topic, cfg):
    topic.send(*(message("A", s) for s in range(50)))
    topic.send(message("A", 500))
    topic.send(message("A", 501))
    topic.send(message("A", 10), message("A", 502))
    topic.send(message("Z", FAR - EPOCH))
    topic.send(message("Z", FAR - EPOCH + 1))
    pipeline, query = run_bronze(spark, cfg)
    assert len(prices(pipeline, "bronze")) == 55
    # its key is forgotten, but it is behind the watermark
    assert prices(pipeline, "late") == [("A", 10, 10.0)]
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 2 * 2
    assert any(p["stateOperators"][0]["numRowsTotal"] >= 50 for p in query.recentProgress)


def test_keys_without_a_time_are_kept_once(spark, topic, cfg):
    cfg = replace(cfg, keep_undecodable=True)
    topic.send("not json", "neither", message("A", 0))
    topic.send("again not")
    pipeline, _ = run_bronze(spark, cfg)
    assert pipeline.tables.read("bronze").where("timestamp IS NULL").count() == 1
    assert pipeline.tables.read("duplicates").count() == 2


def test_balance_of_all_messages(spark, topic, cfg):
    sent = [
        [message("A", 0), message("A", 0, 12.0), message("A", 3), message("B", 4, volume=0), "junk"],
        [message("A", 30)],
        # behind the closed candle, but not behind bronze's watermark
        [message("A", 5), message("A", 31)],
        [message("A", 400)],
        [message("B", 401)],
        [message("A", 7), message("A", 402), message("A", 402)],
        [message("Z", FAR - EPOCH)],
    ]
    pipeline = LayeredPipeline(spark, cfg)
    for texts in sent:
        topic.send(*texts)
        pipeline.run_available()
    found = {r.outcome: r.messages for r in audit.balance(pipeline.tables).collect()}
    assert found == {
        "candles": 7, "late for candles": 1, "open windows": 1, "anomalies": 1, "late": 1, "duplicates": 2, "rejects": 1
    }
    assert sum(found.values()) == sum(map(len, sent))
    behind = audit.ticks_behind_candles(pipeline.tables.read("silver"), pipeline.tables.read("gold"), cfg).where("closed")
    assert [r.timestamp.second for r in behind.collect()] == [5]


def outcomes(pipeline):
    """Symbol, second and price of all rows by table."""
    return {name: prices(pipeline, name) for name in ("bronze", "duplicates", "late")}


def test_rows_go_through_built_in_operators_only(spark, topic, cfg):
    topic.send(message("A", 0), message("A", 0, 12.0), message("A", 1))
    topic.send(message("A", 0), message("A", 300))
    pipeline, query = run_bronze(spark, cfg)
    assert {o["operatorName"] for p in query.recentProgress for o in p["stateOperators"]} == {"dedupe"}
    assert "Python" not in pipeline.frame("bronze")._jdf.queryExecution().toString()
    # the topic is one source, though two branches read it
    assert [len(p["sources"]) for p in query.recentProgress] == [1] * len(query.recentProgress)


# duplicates and late rows if one run takes all batches, and if each has its own, which ends with the new watermark
BY_RUNS = {
    1: (
        [("A", 0, 1.0), ("A", 40, 1.0), ("A", 100, 3.0), ("A", 102, 4.0), ("B", 41, 10.0)],
        [("A", 0, 2.0), *(("A", 40, p) for p in (2.0, 3.0, 4.0)), ("A", 100, 4.0), ("A", 101, 3.0), ("A", 101, 4.0), ("B", 40, 2.0), ("B", 40, 10.0)],
    ),
    6: (
        [("A", 102, 4.0), ("B", 41, 10.0)],
        [
            *(("A", 0, p) for p in (1.0, 2.0)),
            *(("A", 40, p) for p in (1.0, 2.0, 3.0, 4.0)),
            *(("A", second, p) for second in (100, 101) for p in (3.0, 4.0)),
            *(("B", 40, p) for p in (2.0, 10.0)),
        ],
    ),
}


@pytest.mark.parametrize("runs", [1, 6])
def test_keys_around_the_watermark(spark, topic, cfg, runs):
    batches = [
        [message("A", 0), message("A", 40), message("A", 100)],
        # the watermark is at 40: in the batch that it first holds for, known keys up to it are still known, others late
        [message("A", 0, 1.0), message("A", 40, 1.0), message("B", 40), message("B", 41), message("B", 41)],
        # now they are forgotten
        [message("A", 0, 2.0), message("A", 40, 2.0), message("B", 40, 2.0)],
        [message("A", 161)],
        [message("A", 40, 3.0), message("A", 100, 3.0), message("A", 101, 3.0), message("A", 102, 3.0)],
        [message("A", 40, 4.0), message("A", 100, 4.0), message("A", 101, 4.0), message("A", 102, 4.0)],
    ]
    for n, texts in enumerate(batches):
        topic.send(*texts)
        if runs > 1 or n == len(batches) - 1:
            pipeline, _ = run_bronze(spark, cfg)
    found = outcomes(pipeline)
    assert found["bronze"] == [("A", 0, 10.0), ("A", 40, 10.0), ("A", 100, 10.0), ("A", 102, 3.0), ("A", 161, 10.0), ("B", 41, 10.0)]
    assert (found["duplicates"], found["late"]) == BY_RUNS[runs]


def test_a_batch_tried_again_has_the_same_outcomes(spark, topic, cfg):
    topic.send(message("A", 0), message("A", 0, 3.0), message("A", 100))
    topic.send(message("A", 0, 1.0), message("B", 30), message("B", 50), message("A", 200))
    pipeline, _ = run_bronze(spark, cfg)
    found = outcomes(pipeline)
    tables = pipeline.tables
    for kind, first in (("commits", 1), ("offsets", 2)):
        for name, _ in tables.files.folder(f"{cfg.checkpoint('bronze')}/{kind}"):
            number = name.strip(".").removesuffix(".crc")
            if number.isdigit() and int(number) >= first:
                tables.files.delete(f"{cfg.checkpoint('bronze')}/{kind}/{name}")
    topic.send(message("A", 0, 4.0), message("A", 201))
    pipeline, _ = run_bronze(spark, cfg)
    again = outcomes(pipeline)
    assert found["late"] == [("B", 30, 10.0)]
    assert again["bronze"] == sorted([*found["bronze"], ("A", 201, 10.0)])
    assert again["duplicates"] == found["duplicates"] == [("A", 0, 1.0), ("A", 0, 10.0)]
    assert again["late"] == sorted([*found["late"], ("A", 0, 4.0)])
