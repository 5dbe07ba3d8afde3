"""Decode, dedup, enrichment and candles on hand-made rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.config import TickConfig
from tickloom.operators import dedup
from tickloom.plans import layers
from tickloom.schemas import TICK
from tickloom.sources.messages import as_messages

NOW = datetime(2024, 5, 1, 12)
EPOCH = 1714564800  # 2024-05-01 12:00:00 UTC


def decoded(spark, *texts):
    raw = spark.createDataFrame([(t, NOW) for t in texts], "value string, timestamp timestamp")
    return layers.decode(raw.withColumn("value", F.col("value").cast("binary")))


def ticks(spark, *rows):
    """(symbol, price, open, high, low, volume, second)"""
    data = [(*r[:6], NOW + timedelta(seconds=r[6]) if r[6] is not None else None) for r in rows]
    return spark.createDataFrame(data, TICK).withColumn("ingestion_timestamp", F.col("timestamp"))


def test_both_time_encodings(spark):
    body = '{"symbol":"A","price":1.5,"open":1,"high":2,"low":1,"volume":7,"market_cap":5,"source":"x","timestamp":%s}'
    rows = layers.usable_ticks(decoded(spark, body % EPOCH, body % '"2024-05-01T12:00:00"')).collect()
    assert [r["timestamp"] for r in rows] == [NOW, NOW]
    assert rows[0].asDict() == dict(
        symbol="A",
        price=1.5,
        open=1.0,
        high=2.0,
        low=1.0,
        volume=7,
        timestamp=NOW,
        ingestion_timestamp=NOW,
    )


def test_rejects(spark):
    bad = {
        "not json": "not_json",
        '{"symbol":"B"}': "no_timestamp",
        '{"symbol":"B","price":"x","volume":1.5,"timestamp":null}': "no_timestamp",
        '{"symbol":"B","timestamp":1767992401.5}': "no_timestamp",
        '{"timestamp":5}': "no_symbol",
    }
    frame = decoded(spark, *bad, '{"symbol":"A","timestamp":5}')
    got = layers.rejected_messages(frame).collect()
    assert {r["value"]: r["reason"] for r in got} == bad
    assert layers.usable_ticks(frame).count() == 1
    keeping = TickConfig(keep_undecodable=True)
    all_rows = layers.bronze(layers.usable_ticks(frame, keeping), keeping)
    # the (NULL, NULL) rows collapse into one
    assert all_rows.where("symbol IS NULL AND timestamp IS NULL").count() == 1
    # they fall out at the window; the one with a time but no symbol makes a candle
    candles = layers.gold(layers.silver(all_rows, keeping), keeping)
    assert candles.where("window_start IS NULL").count() == 0
    assert candles.where("symbol IS NULL").count() == 1


def test_first_arrival_wins(spark):
    rows = spark.createDataFrame(
        [("A", NOW, 2.0, 20), ("A", NOW, 1.0, 10), ("A", NOW, 3.0, 30), ("B", NOW, 9.0, 40)],
        "symbol string, timestamp timestamp, price double, ingestion_timestamp bigint",
    ).repartition(4)
    kept = dedup.first_arrivals(rows, "1 minute").collect()
    assert sorted((r["symbol"], r["price"]) for r in kept) == [("A", 1.0), ("B", 9.0)]


@pytest.mark.parametrize(
    "row, anomalous",
    [
        (("A", 1.0, 1.0, 1.0, 1.0, 5, 0), False),
        (("A", 1.0, 1.0, 1.0, 1.0, 0, 0), True),
        (("A", 0.0, 1.0, 1.0, 1.0, 5, 0), True),
        (("A", -1.0, 1.0, 1.0, 1.0, 5, 0), True),
        (("A", 1.0, 0.0, 1.0, 1.0, 5, 0), True),
        (("A", 1.0, 1.0, 1.0, 2.0, 5, 0), True),
        (("A", 1.0, 1.0, 1.0, 1.0, None, 0), False),
        (("A", 0.0, 1.0, 1.0, 1.0, None, 0), True),
    ],
)
def test_anomaly(spark, row, anomalous):
    assert layers.enrich(ticks(spark, row)).first()["is_anomaly"] is anomalous


def test_derived_columns(spark):
    rows = layers.enrich(
        ticks(
            spark,
            ("A", 12.0, 10.0, 13.0, 9.0, 5, 0),
            ("B", 12.0, 0.0, 13.0, 9.0, 5, 0),
            ("C", 12.0, None, 13.0, 9.0, 5, 0),
            ("D", 12.0, -4.0, 13.0, 9.0, 5, 0),
        )
    ).collect()
    assert [(r["spread"], r["price_change"], r["price_change_pct"]) for r in rows] == [
        (4.0, 2.0, 20.0),
        (4.0, 12.0, 0.0),
        (4.0, None, 0.0),
        (4.0, 16.0, 0.0),
    ]


def test_text_event_time(spark):
    df = spark.createDataFrame(
        [("A", 1.0, 1.0, 1.0, 1.0, 1, "2024-05-01 12:00:00"), ("A", 1.0, 1.0, 1.0, 1.0, 1, "soon")],
        "symbol string, price double, open double, high double, low double, volume bigint, timestamp string",
    )
    assert [r["timestamp"] for r in layers.enrich(df).collect()] == [NOW, None]


def test_candles(spark):
    rows = ticks(
        spark,
        ("A", 10.0, 10.0, 10.0, 10.0, 1, 0),
        ("A", 10.01, 10.0, 10.01, 10.0, 2, 9),
        ("A", 11.0, 10.0, 11.0, 10.0, 4, 10),
        ("A", 0.0, 10.0, 11.0, 10.0, 4, 11),
        ("B", 5.0, 5.0, 5.0, 5.0, 8, 3),
    )
    got = {
        (r["symbol"], r["window_start"]): r
        for r in layers.gold(layers.enrich(rows), stamp=False).collect()
    }
    assert set(got) == {("A", NOW), ("A", NOW + timedelta(seconds=10)), ("B", NOW)}
    first = got["A", NOW]
    assert first["window_end"] == NOW + timedelta(seconds=10)
    # the mean is 10.005: half up
    assert (first["avg_price"], first["min_price"], first["max_price"]) == (10.01, 10.0, 10.01)
    assert (first["total_volume"], first["trade_count"]) == (3, 2)
    assert first["volatility"] == 0.0071
    single = got["B", NOW]
    assert (single["volatility"], single["trade_count"]) == (0.0, 1)


def test_exact_mean_falls_back_on_extreme_values(spark):
    from tickloom.functions import exact_mean

    df = spark.createDataFrame(
        [("a", 0.1), ("a", 0.2), ("b", 1e300), ("b", 1e300), ("c", float("nan")), ("d", None), ("e", 9e12), ("e", 9e12)],
        "k string, v double",
    )
    got = {r[0]: r[1] for r in df.groupBy("k").agg(exact_mean("v")).collect()}
    assert (got["a"], got["b"], got["d"], got["e"]) == (0.15, 1e300, None, 9e12)
    assert got["c"] != got["c"]


def test_repeats(spark):
    def at(n):
        return NOW + timedelta(seconds=n)

    data = [
        (0, "A", at(1)),
        (1, "A", at(1)),
        (2, "A", at(2)),
        (3, "B", at(1)),
        (4, "A", at(1)),
        (5, "C", None),
        (6, "C", at(1)),
        (7, "C", None),
    ]
    rows = spark.createDataFrame(
        [(n, at(n), s, t) for n, s, t in data], "n int, arrived timestamp, symbol string, timestamp timestamp"
    )
    for seconds, limit in ((1, 100), (3600, 100), (3600, 2)):
        kept = dedup.without_repeats(rows.repartition(3), ["arrived", "n"], seconds, limit).collect()
        assert sorted(r["n"] for r in kept) == [0, 2, 3, 4, 6, 7]


def test_duplicate_audit(spark):
    rows = spark.createDataFrame(
        [("A", NOW)] * 3 + [("B", NOW)] * 2 + [("C", NOW)], "symbol string, timestamp timestamp"
    )
    assert sorted((r["symbol"], r["count"]) for r in dedup.duplicate_groups(rows).collect()) == [("A", 3), ("B", 2)]
    assert [r["symbol"] for r in dedup.worst_duplicates(rows, 1).collect()] == ["A"]
    assert tuple(dedup.duplicate_summary(rows).first()) == (6, 2)


def test_messages_roundtrip(spark):
    rows = ticks(spark, ("A", 1.5, 1.0, 2.0, 1.0, None, 0)).drop("ingestion_timestamp")
    sent = as_messages(rows)
    assert sent.columns == ["key", "value", "timestamp"]
    assert sent.first()["value"] == (
        '{"symbol":"A","price":1.5,"open":1.0,"high":2.0,"low":1.0,"volume":null,"timestamp":%d}' % EPOCH
    )
    back = layers.usable_ticks(layers.decode(sent)).drop("ingestion_timestamp")
    assert back.collect() == rows.collect()
