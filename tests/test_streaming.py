"""The layers as streams: equality with batch, lateness, restarts, rejects, repeats."""

import json
import os
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tickloom.config import TickConfig
from tickloom.operators.dedup import without_repeats
from tickloom.plans import layers
from tickloom.schemas import TICK
from tickloom.sources.messages import as_messages, message_stream, publish_stream
from tickloom.streaming.pipeline import LayeredPipeline
from tickloom.streaming.repeats import RepeatFilter

EPOCH = 1714564800
FAR = EPOCH + 10**7


def message(symbol, second, price=10.0, volume=5):
    return json.dumps(
        dict(symbol=symbol, price=price, open=10.0, high=12.0, low=9.0, volume=volume, timestamp=EPOCH + second)
    )


class Topic:
    """Messages in files that a stream reads in order, one file per batch."""

    def __init__(self, folder):
        self.folder = folder
        self.folder.mkdir()
        self.files = 0

    def send(self, *texts):
        at = datetime.fromtimestamp(EPOCH + self.files, timezone.utc).isoformat()
        lines = [json.dumps({"value": t, "timestamp": at}) for t in texts]
        file = self.folder / f"{self.files:05}.json"
        file.write_text("\n".join(lines))
        # files are taken in the order of their time stamps
        os.utime(file, (EPOCH + self.files, EPOCH + self.files))
        self.files += 1


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path / "topic")


@pytest.fixture
def cfg(tmp_path, topic):
    return TickConfig(
        base_path=str(tmp_path / "lake"),
        source_format="json",
        source_options={"path": str(topic.folder)},
        max_per_batch=1,
    )


def prices(pipeline, table):
    rows = pipeline.tables.read(table).collect()
    return sorted((r["symbol"], int(r["timestamp"].replace(tzinfo=timezone.utc).timestamp()) - EPOCH, r["price"]) for r in rows)


def test_stream_equals_batch(spark, topic, cfg):
    topic.send(message("A", 0, 10.0), message("B", 1, 20.0), "not json")
    topic.send(message("A", 0, 99.0), message("A", 4, 11.0), message("A", 5, 0.0))
    topic.send(message("A", 12, 13.0), message("B", 13, 21.0, volume=0))
    topic.send(message("Z", FAR - EPOCH))
    pipeline = LayeredPipeline(spark, cfg)
    pipeline.run_available()
    raw = spark.read.schema("value string, timestamp timestamp").json(str(topic.folder))
    ticks = layers.usable_ticks(layers.decode(raw))
    bronze = layers.bronze(ticks, stamp=False)
    silver = layers.silver(bronze, stamp=False)
    gold = layers.gold(silver, stamp=False)
    for name, batch in (("bronze", bronze), ("silver", silver), ("gold", gold.where("symbol <> 'Z'"))):
        stored = pipeline.tables.read(name).select(*batch.columns)
        assert sorted(map(str, stored.collect())) == sorted(map(str, batch.collect())), name
    assert ("A", 0, 10.0) in prices(pipeline, "bronze")
    rejected = pipeline.tables.read("rejects").collect()
    assert [(r["value"], r["reason"]) for r in rejected] == [("not json", "not_json")]


def test_restart_goes_on_where_it_stopped(spark, topic, cfg):
    topic.send(message("A", 0))
    LayeredPipeline(spark, cfg).run_available()
    topic.send(message("A", 0, 99.0), message("A", 1))
    topic.send(message("Z", FAR - EPOCH))
    pipeline = LayeredPipeline(spark, cfg)
    pipeline.run_available()
    assert prices(pipeline, "bronze")[:2] == [("A", 0, 10.0), ("A", 1, 10.0)]
    LayeredPipeline(spark, cfg).run_available()
    # each closed window is there once
    assert [(r["symbol"], r["trade_count"]) for r in pipeline.tables.read("gold").collect()] == [("A", 2)]


@pytest.mark.parametrize("ordered", [False, True])
def test_late_rows_are_dropped(spark, topic, cfg, ordered):
    cfg = replace(cfg, ordered_arrivals=ordered)
    for second in (100, 500, 600):
        topic.send(message("A", second))
    topic.send(message("A", 101), message("A", 700))
    topic.send(message("Z", FAR - EPOCH))
    pipeline = LayeredPipeline(spark, cfg)
    query = pipeline.run_layer("bronze", available_now=True)
    query.awaitTermination()
    seconds = [s for _, s, _ in prices(pipeline, "bronze")]
    assert seconds == [100, 500, 600, 700, FAR - EPOCH]
    if ordered:
        assert [s for _, s, _ in prices(pipeline, "late")] == [101]
        assert pipeline.tables.read("duplicates").count() == 0
    else:
        dropped = sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
        assert dropped == 1


def test_undecodable_can_be_kept(spark, topic, cfg):
    cfg = replace(cfg, keep_undecodable=True)
    topic.send("not json", message("A", 0))
    pipeline = LayeredPipeline(spark, cfg)
    pipeline.run_available()
    assert pipeline.tables.read("bronze").where("timestamp IS NULL").count() == 1
    assert not pipeline.tables.exists("rejects")


def test_continuous_run_stops_all(spark, topic, cfg):
    topic.send(message("A", 0))
    pipeline = LayeredPipeline(spark, cfg)
    for name in pipeline.layer_names:
        pipeline.run_layer(name)
    assert {q.name for q in spark.streams.active} == {f"{n}_ingestion" for n in ("bronze", "silver", "gold", "rejects")}
    for name in pipeline.layer_names:
        pipeline.queries[name].processAllAvailable()
    # silver started on an empty table: its columns keep their places
    for name in ("bronze", "silver"):
        assert pipeline.tables.read(name).select("symbol", "price", "volume").collect() == [("A", 10.0, 5)]
    pipeline.stop()
    assert not spark.streams.active


def test_publish_stream(spark, tmp_path, topic, cfg):
    rows = spark.createDataFrame([("A", 1.5, 1.0, 2.0, 1.0, 7, datetime(2024, 5, 1, 12))], TICK)
    rows.write.parquet(str(tmp_path / "rows"))
    stream = spark.readStream.schema(TICK).parquet(str(tmp_path / "rows"))
    publish_stream(
        as_messages(stream), "json", {"path": str(topic.folder)}, str(tmp_path / "checkpoint")
    ).processAllAvailable()
    for query in spark.streams.active:
        query.stop()
    assert message_stream(spark, cfg).isStreaming
    LayeredPipeline(spark, cfg).run_layer("bronze", available_now=True).awaitTermination()
    back = LayeredPipeline(spark, cfg).tables.read("bronze").select(*TICK.names)
    assert back.collect() == rows.collect()


def test_repeats_across_batches(spark, tmp_path):
    start = datetime(2024, 5, 1)

    def at(n):
        return start + timedelta(seconds=n)

    # (arrival, symbol, quote time or None), per batch
    batches = [
        [(0, "A", 1), (1, "A", 1), (2, "B", None), (3, "A", 2)],
        [(4, "A", 2), (5, "B", 1), (6, "A", 1)],
        [(7, "C", 9)],
        [(8, "A", 1), (9, "B", 2), (10, "B", 2), (11, "C", 9), (12, "C", None)],
    ]
    schema = "n int, arrived timestamp, symbol string, timestamp timestamp"
    rows = [[(n, at(n), s, None if t is None else at(t)) for n, s, t in batch] for batch in batches]
    frames = [spark.createDataFrame(batch, schema) for batch in rows]
    out = str(tmp_path / "out")
    repeat = RepeatFilter(spark, out, str(tmp_path / "state"), ["arrived", "n"], TickConfig(max_slice_rows=3))
    for i, frame in enumerate(frames):
        repeat.process(frame, i)
        repeat.process(frame, i)  # a replay changes nothing
    got = sorted(r["n"] for r in spark.read.parquet(out).collect())
    everything = spark.createDataFrame([r for batch in rows for r in batch], schema)
    want = without_repeats(everything, ["arrived", "n"], 3600, 100)
    assert got == sorted(r["n"] for r in want.collect()) == [0, 3, 5, 6, 7, 9, 12]


def test_gold_watermark_closes_windows_once(spark, topic, cfg):
    topic.send(message("A", 0), message("A", 9))
    topic.send(message("A", 14))  # watermark 9: the first window stays open
    topic.send(message("A", 15))  # watermark 10: closes it
    pipeline = LayeredPipeline(spark, cfg)
    pipeline.run_available()
    got = pipeline.tables.read("gold").select("trade_count", F.unix_seconds("window_end") - EPOCH).collect()
    assert [tuple(r) for r in got] == [(2, 10)]


def test_continuous_run_waits_for_its_own_queries(spark, topic, cfg):
    import threading
    import time

    topic.send(message("A", 0))
    LayeredPipeline(spark, cfg).run_available()  # leaves ended queries in the session
    pipeline = LayeredPipeline(spark, cfg)
    ended = []
    runner = threading.Thread(target=lambda: ended.append(pipeline.run_continuously()))
    runner.start()
    topic.send(message("A", 1))
    for _ in range(120):
        if len(prices(pipeline, "silver")) == 2:
            break
        time.sleep(0.5)
    assert len(prices(pipeline, "silver")) == 2 and runner.is_alive()
    pipeline.queries["gold"].stop()
    runner.join(60)
    assert ended == [None] and not spark.streams.active


def test_a_failing_layer_raises_and_stops_the_rest(spark, topic, cfg, monkeypatch):
    topic.send(message("A", 0))
    pipeline = LayeredPipeline(spark, cfg)
    write = pipeline.tables._write_load

    def broken(name, df, load):
        if name == "silver":
            raise OSError("disk is full")
        write(name, df, load)

    monkeypatch.setattr(pipeline.tables, "_write_load", broken)
    with pytest.raises(Exception, match="disk is full"):
        pipeline.run_continuously()
    assert not spark.streams.active


def test_batch_and_stream_rows_stand_side_by_side(spark, topic, cfg):
    from tickloom.sources.tables import Tables

    tables = Tables(spark, cfg)
    row = "SELECT '{}' AS symbol, timestamp '2024-01-01' AS window_start, timestamp '2024-01-02' AS window_end, "
    row += "1.0D AS avg_price, 1.0D AS min_price, 1.0D AS max_price, 0.0D AS volatility, 1L AS total_volume, "
    row += "1L AS trade_count, 0.0D AS avg_price_change_pct, timestamp '2024-01-02' AS gold_computed_at"
    tables.append("gold", spark.sql(row.format("HISTORY")))
    topic.send(message("A", 0))
    topic.send(message("Z", FAR - EPOCH))
    LayeredPipeline(spark, cfg).run_available()
    tables.append("gold", spark.sql(row.format("BACKFILL")))
    assert sorted(r.symbol for r in tables.read("gold").collect()) == ["A", "BACKFILL", "HISTORY"]
