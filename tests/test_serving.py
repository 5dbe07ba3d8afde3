"""Serving queries, features, labels and splits on hand-made candles."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.functions import risk_band, signal_band, signal_or_fallback, strong_prediction
from tickloom.operators import ranking
from tickloom.plans import features, serving
from tickloom.schemas import GOLD

T0 = datetime(2024, 5, 1, 23, 30)


def candles(spark, *rows, every=60):
    """(symbol, minute, avg price, volume)"""
    data = []
    for symbol, minute, price, volume in rows:
        at = T0 + timedelta(seconds=every * minute)
        data.append((at, at + timedelta(seconds=every), symbol, price, price, price, 0.5, volume, 1, 0.1, T0))
    return spark.createDataFrame(data, GOLD)


def series(spark, symbol, prices):
    return candles(spark, *((symbol, i, p, 10) for i, p in enumerate(prices)))


@pytest.mark.parametrize(
    "probability, signal", [(0.55, "HOLD"), (0.5500001, "BUY"), (0.45, "HOLD"), (0.4499999, "SELL")]
)
def test_signal_band(spark, probability, signal):
    assert spark.range(1).select(signal_band(F.lit(probability))).first()[0] == signal


@pytest.mark.parametrize(
    "stored, probability, shown",
    [("HOLD", 0.9, "HOLD"), (None, 0.6, "BUY"), ("WAIT", 0.5, "SELL"), ("WAIT", 0.0, "WAIT"), (None, None, "WAIT")],
)
def test_signal_fallback(spark, stored, probability, shown):
    df = spark.createDataFrame([(stored, probability)], "s string, p double")
    assert df.select(signal_or_fallback(F.col("s"), F.col("p"))).first()[0] == shown


def test_risk_and_strength(spark):
    df = spark.createDataFrame([(1.0, 0.6), (1.1, 0.61), (None, None)], "v double, p double")
    got = df.select(risk_band(F.col("v")), strong_prediction(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("Stable", False), ("High Risk", True), ("Stable", False)]


def test_volume_delta(spark):
    rows = candles(spark, *(("A", i, 1.0, v) for i, v in enumerate([10, 15, 12, 12])), ("B", 2, 1.0, 5))
    got = serving.price_series_of(rows, "A").collect()
    assert [r["volume_delta"] for r in got] == [0, 5, 0, 0]
    assert [r["time"] for r in got] == sorted(r["time"] for r in got)


def test_trend(spark):
    short = series(spark, "A", [1.0, 2.0])
    flat = series(spark, "B", [9.0, 4.0, 4.0, 4.0, 4.0, 4.0])
    got = {r["symbol"]: (r["mean_price"], r["trend"]) for r in serving.trend(short.union(flat)).collect()}
    assert got == {"A": (1.5, "Bullish"), "B": (4.0, "Bearish")}


def test_latest_windows(spark):
    rows = series(spark, "A", [float(i) for i in range(6)]).union(series(spark, "B", [1.0]))
    got = serving.latest_windows(rows, 2).collect()
    assert sorted((r["symbol"], r["avg_price"]) for r in got) == [("A", 4.0), ("A", 5.0), ("B", 1.0)]
    assert [r["avg_price"] for r in serving.latest_windows_of(rows, "A", 2).collect()] == [5.0, 4.0]


def test_large_limits_are_exact(spark):
    rows = spark.range(5000).select(F.lit("A").alias("symbol"), F.timestamp_seconds("id").alias("at"))
    got = ranking.newest(rows.repartition(7), 1500, "at").agg(F.count("*"), F.min(F.unix_seconds("at"))).first()
    assert tuple(got) == (1500, 3500)


def test_movers_and_volatile(spark):
    rows = series(spark, "A", [1.0] * 12).withColumn(
        "avg_price_change_pct", F.minute("window_start").cast("double") - 36.0
    )
    got = serving.top_movers(rows, 3).collect()
    # minutes 30 to 41 give -6 to 5
    assert [abs(r["avg_price_change_pct"]) for r in got] == [6.0, 5.0, 5.0]
    assert got[0].asDict().keys() == {"symbol", "window_start", "window_end", "avg_price_change_pct", "avg_price"}
    assert serving.volatile_windows(rows.withColumn("volatility", F.lit(2.0))).count() == 0
    assert serving.volatile_windows(rows.withColumn("volatility", F.lit(2.1))).count() == 12


def test_features(spark):
    rows = candles(
        spark, ("A", 0, 0.0, 1), ("A", 1, 2.0, 0), ("A", 2, 4.0, 9), ("A", 5, 2.0, None), ("B", 0, 1.0, 1)
    )
    got = features.features(rows).collect()
    assert [(r["avg_price"], r["prev_price"], round(r["log_returns"], 6), round(r["log_volume"], 6)) for r in got] == [
        (4.0, 2.0, 0.693147, 2.302585)
    ]
    no_volatility = rows.withColumn("volatility", F.lit(None).cast("double"))
    assert features.features(no_volatility).first()["volatility"] == 0.0


def test_labels_cross_slice_borders(spark):
    # every 8 hours: each one-day slice holds three candles
    rows = candles(spark, *(("A", i, p, 1) for i, p in enumerate([1.0, 2.0, 2.0, 3.0, 1.0, 4.0, 5.0, 2.0])), every=28800)
    got = {r["window_start"]: (r["next_price"], r["label"]) for r in features.labelled(rows).collect()}
    assert [got[t] for t in sorted(got)] == [(2.0, 0.0), (3.0, 1.0), (1.0, 0.0), (4.0, 1.0), (5.0, 1.0), (2.0, 0.0)]


@pytest.mark.parametrize("rows, train, test", [(1, 1, 0), (5, 4, 1), (10, 8, 2)])
def test_split(spark, rows, train, test):
    # the first candle has no return and the last no label
    split = features.time_split(series(spark, "A", [1.0 + i % 2 for i in range(rows + 2)]))
    counts = {r["split"]: r["row_count"] for r in features.split_counts(split).collect()}
    assert (counts.get("train", 0), counts.get("test", 0)) == (train, test)
    edges = split.agg(
        F.max(F.when(F.col("split") == "train", F.col("window_start"))),
        F.min(F.when(F.col("split") == "test", F.col("window_start"))),
    ).first()
    assert edges[1] is None or edges[0] < edges[1]


def test_newest_forms_agree(spark):
    rows = series(spark, "A", [1.0, 2.0]).union(series(spark, "B", [3.0]))
    rows = rows.union(rows.where("symbol = 'B'"))
    by_rank = ranking.newest_with_ties(rows).select("symbol", "avg_price").collect()
    by_join = ranking.newest_by_join(rows).select("symbol", "avg_price").collect()
    assert sorted(by_rank) == sorted(by_join) == [("A", 2.0), ("B", 3.0), ("B", 3.0)]


def test_kpi_board(spark):
    rows = series(spark, "A", [1.0, 5.0, 2.0]).union(series(spark, "B", [3.0]))
    at = T0 + timedelta(minutes=1)
    predictions = spark.createDataFrame(
        [("A", at, 0.9, None), ("A", at - timedelta(minutes=1), 0.1, "SELL")],
        "symbol string, window_end timestamp, probability double, signal string",
    )
    board = {r["symbol"]: r for r in serving.kpi_board(rows, predictions).collect()}
    a, b = board["A"], board["B"]
    assert (a["price"], a["session_high"], a["session_low"], a["window_spread"]) == (2.0, 5.0, 1.0, 0.0)
    assert (a["signal"], a["strong"], a["trend"], a["risk"]) == ("BUY", True, "Bearish", "Stable")
    assert (b["signal"], b["probability"], b["strong"]) == ("WAITING", None, False)


@pytest.mark.parametrize("n", [1001, 1500, 4000, 10**6])
def test_newest_of_a_hot_symbol(spark, n):
    """Nine tenths of the rows in one symbol, many of them in one second, some without a time or a symbol."""
    at = F.when(F.col("id") % 97 == 0, None).when(F.col("id") % 3 == 0, F.lit(5_000)).otherwise(F.col("id") * 7 % 40_000)
    symbol = F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") % 20 == 0, None).otherwise("cold")
    rows = spark.range(12_000).select("id", symbol.alias("symbol"), F.timestamp_seconds(at).alias("at")).repartition(7)
    got = ranking.newest(rows, n, "at", [F.asc("id")])
    w = Window.partitionBy("symbol").orderBy(F.desc("at"), "id")
    want = rows.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= n).drop("nth")
    assert got.columns == rows.columns
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect())
