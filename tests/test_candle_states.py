"""Candles merged from stored parts against candles from the ticks."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.config import TickConfig
from tickloom.operators.candle_states import candles_of, states
from tickloom.operators.candles import candles
from tickloom.plans import layers
from tickloom.schemas import STATES
from tickloom.sources.tables import Tables
from tickloom.streaming.pipeline import LayeredPipeline
from tests.test_streaming import EPOCH, FAR, Topic, message

T0 = datetime(2024, 5, 1, 12)


def ticks(spark, rows):
    schema = "symbol string, timestamp timestamp, price double, volume long, price_change_pct double"
    return spark.createDataFrame([(s, T0 + timedelta(seconds=t), p, v, c) for s, t, p, v, c in rows], schema).repartition(5)


def random_rows(seed, digits=2, base=100.0, count=3000):
    rng = random.Random(seed)
    return [
        (rng.choice(["hot", "hot", "hot", "cold"]), rng.randrange(7200), round(base + rng.gauss(0, 3), digits), rng.randrange(9), rng.uniform(-5, 5))
        for _ in range(count)
    ]


@pytest.mark.parametrize("base", [100.0, 1e6, 0.0])
@pytest.mark.parametrize("window, slide", [("10 seconds", None), ("1 minute", None), ("1 hour", None), ("1 hour", "30 minutes")])
def test_equal_to_candles_of_the_ticks(spark, window, slide, base):
    df = ticks(spark, random_rows(1, base=base))
    parts = states(df, "10 seconds")
    assert parts.dtypes == [(f.name, f.dataType.simpleString()) for f in STATES.fields]
    got = candles_of(parts, window, slide)
    want = candles(df, window, slide)
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_merged_twice(spark):
    """A small deviation beside a large mean is not lost."""
    prices = [9_000_000.0, 9_000_000.01, 9_000_000.02] * 400
    df = ticks(spark, [("A", k * 3, p, 1, 0.0) for k, p in enumerate(prices)])
    mean = sum(p - 9e6 for p in prices) / len(prices)
    want = math.sqrt(sum((p - 9e6 - mean) ** 2 for p in prices) / (len(prices) - 1))
    assert candles_of(states(df, "10 seconds"), "1 hour").first().volatility == round(want, 4) == 0.0082


def test_odd_prices(spark):
    rows = [("none", 0, None, None, None), ("none", 1, None, 2, None), ("huge", 0, 1e200, 1, 1.0), ("huge", 1, 3e200, 1, 2.0)]
    rows += [("fine", t, 10 + t / 3, 1, t / 7) for t in range(40)] + [("one", 5, 2.5, None, 1.0)]
    df = ticks(spark, rows)
    got = {r.symbol: r for r in candles_of(states(df, "10 seconds"), "1 hour").collect()}
    want = {r.symbol: r for r in candles(df, "1 hour").collect()}
    assert got["none"] == want["none"] and got["one"] == want["one"] and got["fine"] == want["fine"]
    assert got["huge"].avg_price == pytest.approx(2e200) and got["huge"].avg_price_change_pct == 1.5
    nan = ticks(spark, [("A", 0, float("nan"), 1, 0.0), ("A", 1, 1.0, 1, 0.0)])
    assert math.isnan(candles_of(states(nan, "10 seconds"), "1 hour").first().avg_price)


def test_stored_by_a_stream(spark, tmp_path):
    topic = Topic(tmp_path / "topic")
    cfg = TickConfig(base_path=str(tmp_path / "lake"), source_format="json", source_options={"path": str(topic.folder)}, max_per_batch=1)
    for second in (0, 4, 25, 70, 3700):
        topic.send(message("A", second, 10.0 + second % 7))
    topic.send(message("Z", FAR - EPOCH))
    pipeline = LayeredPipeline(spark, cfg)
    pipeline.run_available()
    pipeline.run_layer("states", available_now=True).awaitTermination()
    tables = Tables(spark, cfg)
    assert tables.compact("states", least_loads=1) > 0
    got = candles_of(tables.read("states"), "1 hour").orderBy("window_start").collect()
    want = layers.gold(tables.read("silver").where("symbol = 'A'"), TickConfig(window="1 hour"), stamp=False).orderBy("window_start").collect()
    assert got == want and [r.trade_count for r in got] == [4, 1]
    assert candles_of(tables.read("states"), "10 seconds").select(F.sum("trade_count")).first()[0] == 5
