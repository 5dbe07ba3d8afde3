"""Loads and their ledger: replays, races, caps, compaction, ranges, growth."""

import threading
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.config import TickConfig
from tickloom.plans import layers
from tickloom.schemas import GOLD, SILVER
from tickloom.sources.ledger import Files, Ledger, Load, batch_load
from tickloom.sources.tables import Tables
from tickloom.streaming.pipeline import LAYERS, LayeredPipeline
from tests.test_streaming import EPOCH, FAR, Topic, message

T0 = datetime(2024, 5, 1, 12)


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path / "topic")


@pytest.fixture
def cfg(tmp_path, topic):
    return TickConfig(base_path=str(tmp_path / "lake"), source_format="json", source_options={"path": str(topic.folder)})


@pytest.fixture
def lake(spark, tmp_path):
    return Tables(spark, TickConfig(base_path=str(tmp_path / "tables")))


def candles(spark, *rows):
    """Candles of one minute from (symbol, price, minutes after T0)."""
    full = []
    for symbol, price, minute in rows:
        at = T0 + timedelta(minutes=minute)
        full.append((at, at + timedelta(minutes=1), symbol, price, price, price, 0.5, 10, 1, 0.1, T0))
    return spark.createDataFrame(full, GOLD)


def take_back(cfg, layer, batch):
    """The checkpoint as a crash leaves it that comes after the batch was written and before it was committed."""
    from pathlib import Path

    place = Path(cfg.checkpoint(layer))
    for folder, first in (("commits", batch), ("offsets", batch + 1)):
        for file in (place / folder).iterdir():
            if file.name.strip(".").removesuffix(".crc").isdigit() and int(file.name.strip(".").removesuffix(".crc")) >= first:
                file.unlink()


@pytest.mark.parametrize("layer", LAYERS)
def test_a_batch_replayed_after_a_crash_counts_once(spark, topic, cfg, layer):
    topic.send(message("A", 0), message("A", 1), message("A", 2))
    topic.send(message("Z", FAR - EPOCH))
    LayeredPipeline(spark, cfg).run_available()
    take_back(cfg, layer, 0)
    pipeline = LayeredPipeline(spark, cfg)
    pipeline.run_available()
    tables = pipeline.tables
    assert tables.read("bronze").where("symbol = 'A'").count() == 3
    assert tables.read("silver").where("symbol = 'A'").count() == 3
    gold = tables.read("gold").where("symbol = 'A'").collect()
    assert [(r.trade_count, r.total_volume) for r in gold] == [(3, 15)]


@pytest.mark.parametrize("layer", LAYERS)
def test_a_try_that_did_not_get_to_its_entry_is_not_read(spark, topic, cfg, layer, monkeypatch):
    topic.send(message("A", 0), message("A", 1), message("A", 2))
    topic.send(message("Z", FAR - EPOCH))
    commit = Ledger.commit
    failed = []

    def broken(self, load, adds, *rest, **named):
        if self.table.endswith(f"/{layer}") and not failed:
            failed.append(adds[0].path)
            raise OSError("gone away")
        return commit(self, load, adds, *rest, **named)

    monkeypatch.setattr(Ledger, "commit", broken)
    with pytest.raises(Exception, match="gone away"):
        LayeredPipeline(spark, cfg).run_available()
    pipeline = LayeredPipeline(spark, cfg)
    pipeline.run_available()
    tables = pipeline.tables
    gold = tables.read("gold").where("symbol = 'A'").collect()
    assert [(r.trade_count, r.total_volume) for r in gold] == [(3, 15)]
    assert tables.read(layer).where("symbol = 'A'").count() == (1 if layer == "gold" else 3)
    assert tables.vacuum(layer, keep_hours=0) == failed


def test_a_reader_never_sees_a_load_missing(spark, lake):
    load = batch_load("query", 0)
    lake._write_load("gold", candles(spark, ("A", 1.0, 0)), load)
    seen, stop = [], threading.Event()

    def look():
        while not stop.is_set():
            seen.append(Tables(spark, lake.cfg).read("gold").count())

    reader = threading.Thread(target=look)
    reader.start()
    for _ in range(3):
        Tables(spark, lake.cfg)._write_load("gold", candles(spark, ("A", 1.0, 0)), load)
    stop.set()
    reader.join(60)
    assert seen and set(seen) == {1}


def test_numbers_are_given_once(spark, tmp_path):
    files = Files(spark)
    ledgers = [Ledger(files, files.full_name(str(tmp_path / "t"))) for _ in range(4)]
    done = []

    def write(k):
        for n in range(5):
            done.append(ledgers[k].commit(f"b-{k}-{n}", [Load(f"load={k}-{n}", ["f"])]))
            done.append(ledgers[k].commit(batch_load("same", n), [Load(f"load=same-{n}-{k}", ["f"])]))

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(60)
    paths = [x.path for x in Ledger(files, ledgers[0].table).loads()]
    assert len(paths) == len(set(paths)) == 25 == sum(done)
    assert sorted(p.split("-")[1] for p in paths if "same" in p) == list("01234")


def test_snapshots_say_what_the_entries_say(spark, tmp_path):
    files = Files(spark)
    ledger = Ledger(files, files.full_name(str(tmp_path / "t")))
    for n in range(60):
        assert ledger.commit(batch_load("q", n), [Load(f"load={n}", ["f"], n, n, n)])
    assert ledger.commit("c-1", [Load("c-1/load=d", ["f"], day="d")], ["load=3", "load=4"], "rewrite")
    assert not ledger.commit("c-2", [Load("c-2/load=d", ["f"], day="d")], ["load=3"], "rewrite")
    again = Ledger(files, ledger.table)
    assert again.loads() == ledger.loads() and len(again.loads()) == 59
    assert again.holds(batch_load("q", 59)) and not again.holds(batch_load("q", 60)) and again.holds("c-1")
    assert [x.path for x in again.loads(since=10, until=12)] == ["load=10", "load=11", "c-1/load=d"]


def test_empty_batches_leave_nothing(spark, lake):
    lake.append("gold", candles(spark, ("A", 1.0, 0)).limit(0))
    assert lake.ledger("gold").loads() == [] and lake.read("gold").count() == 0


def test_backlog_is_taken_in_whole_loads(spark, lake):
    """Loads whose files hold different symbols over the same time: in parts, the first would drop the second."""
    cfg = replace(lake.cfg, max_loads_per_batch=4)
    ticks = spark.range(600).select(
        F.concat(F.lit("S"), F.col("id") % 3).alias("symbol"),
        *(F.lit(10.0).alias(c) for c in ("price", "open", "high", "low")),
        F.lit(5).cast("long").alias("volume"),
        F.timestamp_seconds(F.lit(EPOCH) + F.col("id") * 2).alias("timestamp"),
        F.timestamp_seconds(F.lit(EPOCH) + F.col("id") * 2).alias("ingestion_timestamp"),
        F.lit(None).cast("timestamp").alias("bronze_inserted_at"),
        "id",
    )
    rows = layers.enrich(ticks).withColumn("silver_processed_at", F.current_timestamp()).cache()
    for n in range(50):
        lake.append("silver", rows.where(F.floor(F.col("id") / 12) == n).select(*SILVER.names))
    last = rows.limit(1).withColumn("timestamp", F.timestamp_seconds(F.lit(FAR))).select(*SILVER.names)
    lake.append("silver", last)
    pipeline = LayeredPipeline(spark, cfg)
    query = pipeline.run_layer("gold", available_now=True)
    query.awaitTermination()
    with_rows = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(with_rows) == 13
    got = pipeline.tables.read("gold").drop("gold_computed_at").collect()
    want = layers.gold(rows, cfg, stamp=False).select(*[c for c in GOLD.names if c != "gold_computed_at"]).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(want) == 360


def test_compaction_gathers_loads_by_day(spark, lake):
    for n in range(12):
        lake.append("gold", candles(spark, ("A", float(n), n * 300), ("B", float(n), n * 300 + 1)))
    before = lake.read("gold")
    rows = sorted(map(str, before.collect()))
    assert lake.compact("gold") == 12 and lake.compact("gold") == 0
    loads = lake.ledger("gold").loads()
    assert [x.day for x in loads] == ["2024-05-01", "2024-05-02", "2024-05-03", "2024-05-04"][: len(loads)] and len(loads) == 3
    assert sum(len(x.files) for x in loads) == 6
    assert sorted(map(str, lake.read("gold").collect())) == rows
    # a reader from before goes on, until the old files are cleaned away
    assert sorted(map(str, before.collect())) == rows
    assert len(lake.vacuum("gold", keep_hours=0)) == 12
    assert sorted(map(str, lake.read("gold").collect())) == rows
    # small days take part again
    lake.append("gold", candles(spark, ("A", 99.0, 10)))
    lake.append("gold", candles(spark, ("C", 99.0, 20)))
    assert lake.compact("gold") == 3
    assert [x.day for x in lake.ledger("gold").loads()] == ["2024-05-02", "2024-05-03", "2024-05-01"]
    assert lake.read("gold").count() == 26


def test_a_time_range_opens_only_its_day(spark, lake):
    for n in range(8):
        lake.append("gold", candles(spark, ("A", float(n), n * 720)))
    lake.compact("gold")
    lake.append("gold", candles(spark, ("B", 50.0, 0)))
    some = lake.read("gold", datetime(2024, 5, 3), datetime(2024, 5, 4))
    assert [r.avg_price for r in some.orderBy("avg_price").collect()] == [3.0, 4.0]
    assert {f.split("load=")[1].split("/")[0][-10:] for f in some.inputFiles()} == {"2024-05-03"}
    assert lake.read("gold", since=datetime(2024, 5, 4, 12)).count() == 2
    assert lake.read("gold", until=datetime(2024, 5, 1, 12, 1)).count() == 2
    assert lake.read("gold", since=datetime(2030, 1, 1)).count() == 0


def test_streams_go_on_across_a_compaction(spark, topic, cfg):
    topic.send(message("A", 0), message("A", 1))
    pipeline = LayeredPipeline(spark, cfg)
    pipeline.run_available()
    topic.send(message("A", 2))
    pipeline.run_layer("bronze", available_now=True).awaitTermination()
    # gold has taken the first of silver's loads; silver is rewritten before it takes the next
    pipeline.run_layer("silver", available_now=True).awaitTermination()
    assert pipeline.tables.compact("bronze") and pipeline.tables.compact("silver")
    topic.send(message("Z", FAR - EPOCH))
    LayeredPipeline(spark, cfg).run_available()
    assert [(r.symbol, r.trade_count) for r in pipeline.tables.read("gold").collect()] == [("A", 3)]


def test_a_stream_behind_what_is_kept_says_so(spark, topic, cfg):
    topic.send(message("A", 0))
    topic.send(message("A", 1))
    cfg = replace(cfg, max_per_batch=1)
    pipeline = LayeredPipeline(spark, cfg)
    pipeline.run_layer("bronze", available_now=True).awaitTermination()
    assert pipeline.tables.compact("bronze") == 2
    pipeline.tables.vacuum("bronze", keep_hours=0)
    with pytest.raises(Exception, match="cleaned away"):
        pipeline.run_layer("silver", available_now=True).awaitTermination()


def test_stream_rows_are_typed_as_declared(spark, lake):
    row = candles(spark, ("7203", 1.5, 0)).unionByName(candles(spark, ("A B/é", 2.5, 1)))
    lake.append("gold", row.withColumn("volatility", F.lit(None).cast("double")))
    lake.append("gold", candles(spark, ("old", 3.5, 2)).drop("gold_computed_at"))
    out = lake.cfg.path("copy")
    query = lake.read_stream("gold").writeStream.format("parquet").option("checkpointLocation", f"{out}_c").trigger(availableNow=True).start(out)
    query.awaitTermination()
    copy = spark.read.parquet(out)
    assert copy.dtypes == lake.read("gold").dtypes
    assert sorted(map(str, copy.collect())) == sorted(map(str, lake.read("gold").collect()))
