"""Shapes of the physical plans that matter at scale."""

import re

import pytest

from tickloom.config import TickConfig
from tickloom.plans import features, layers, serving
from tickloom.schemas import GOLD, RAW_MESSAGE
from tickloom.session import stage

CFG = TickConfig(window="1 hour")


def plan(df):
    """The physical plan, planned as for large tables (nothing is known to be small)."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture(scope="module")
def gold(spark):
    return stage(spark.createDataFrame([], GOLD), "gold")


@pytest.fixture(scope="module")
def messages(spark):
    return stage(spark.createDataFrame([], RAW_MESSAGE), "messages")


def test_dedup_limits_before_the_shuffle_and_shuffles_once(messages):
    bronze = layers.bronze(layers.usable_ticks(layers.decode(messages)), CFG)
    text = plan(layers.silver(bronze, CFG))
    assert text.count("Exchange hashpartitioning") == 1
    below_exchange = text[text.index("Exchange hashpartitioning") :]
    assert re.search(r"WindowGroupLimit .* Partial", below_exchange)


def test_candles_aggregate_before_the_shuffle(spark, messages):
    silver = layers.silver(layers.usable_ticks(layers.decode(messages)), CFG)
    text = plan(layers.gold(silver, CFG))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text
    assert "partial_stddev" in text[text.index("Exchange hashpartitioning(window") :]


def test_messages_are_parsed_once(messages):
    text = plan(layers.usable_ticks(layers.decode(messages)))
    assert text.count("from_json(") == 1


def test_feature_chain_shares_one_partitioning(gold):
    text = plan(features.time_split(gold, CFG))
    # rows shuffle once for all windows of the main path, once per edge table
    by_slice = re.findall(r"Exchange hashpartitioning\(_key#\d+, _slice#\d+L, _part", text)
    assert len(by_slice) <= 4
    assert "Python" not in text and "CartesianProduct" not in text


def test_top_lists_do_not_sort_everything(gold):
    assert "TakeOrderedAndProject" in plan(serving.top_movers(gold))
    assert re.search(r"WindowGroupLimit .* Partial", plan(serving.latest_windows(gold, 100)))
    assert re.search(r"WindowGroupLimit .* Partial", plan(serving.trend(gold)))


def test_scans_read_only_what_they_need(gold):
    text = plan(serving.volatile_windows(gold))
    assert "PushedFilters: [IsNotNull(volatility), GreaterThan(volatility,2.0)]" in text
    assert "ReadSchema: struct<window_start:timestamp,symbol:string,avg_price:double,volatility:double>" in text


def test_no_python_workers_in_batch_queries(gold):
    frames = (
        serving.kpi_board(gold, gold.select("symbol", "window_end", "volatility").toDF("symbol", "window_end", "probability").selectExpr("*", "'BUY' AS signal")),
        serving.price_series(gold, CFG),
        serving.symbol_stats(gold),
        features.labelled(gold, CFG),
    )
    for frame in frames:
        text = plan(frame)
        assert "Python" not in text and "Arrow" not in text and "NestedLoop" not in text


def test_appends_split_a_hot_symbol(gold):
    text = plan(gold.hint("rebalance", "symbol"))
    assert "REBALANCE_PARTITIONS_BY_COL" in text
