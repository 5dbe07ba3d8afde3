"""Payload normalisers, feature files and layer tables."""

import json
from datetime import datetime

import pytest

from tickloom.config import TickConfig
from tickloom.plans import serving
from tickloom.plans.sql import run_sql
from tickloom.schemas import GOLD, TABLES
from tickloom.sources.feature_files import read_feature_files, unreadable_files
from tickloom.sources.payloads import ticks_from_quotes, ticks_from_series
from tickloom.sources.tables import Tables

T0 = datetime(2024, 5, 1, 12)


def payload_frame(spark, *payloads):
    texts = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
    return spark.createDataFrame([(f"S{i}", t) for i, t in enumerate(texts)], "symbol string, payload string")


def entry(close, **other):
    fields = {"1. open": "1", "2. high": "3", "3. low": "0.5", "4. close": close, "5. volume": "70"}
    return {k: v for k, v in {**fields, **other}.items() if v is not None}


def test_series_payload(spark):
    series = "Time Series (1min)"
    frame = payload_frame(
        spark,
        {"Meta Data": {"1. Information": "x"}, series: {"2024-05-01 11:59:00": entry("9"), "2024-05-01 12:00:00": entry("2.5")}},
        {"Note": "no more calls today"},
        {series: {}},
        {series: {"2024-05-01 12:00:00": entry("n/a")}},
        {series: {"2024-05-01 12:00:00": entry("2", **{"5. volume": None})}},
        {series: {"noon": entry("2")}},
        "garbage",
        {"Time Series (5min)": {"2024-05-01 12:00:00": entry("2")}},
    )
    rows = ticks_from_series(frame).collect()
    assert [tuple(r) for r in rows] == [("S0", 2.5, 1.0, 3.0, 0.5, 70, T0, "alpha_vantage")]
    assert [r["symbol"] for r in ticks_from_series(frame, interval="5min").collect()] == ["S7"]


def test_quote_payload(spark):
    frame = payload_frame(
        spark,
        {"currency": "EUR", "exchange": "XPAR", "currentPrice": 2.5, "open": 2, "dayHigh": 3, "dayLow": 1,
         "regularMarketVolume": 7, "volume": 9, "marketCap": 10**12, "regularMarketTime": 1714564800},
        {"regularMarketVolume": 0, "volume": 9},
        {"currency": None, "exchange": None, "currentPrice": None, "open": 0, "dayHigh": ""},
        {"currentPrice": "many"},
        "garbage",
    )
    rows = {r["symbol"]: tuple(r)[1:] for r in ticks_from_quotes(frame).collect()}
    assert rows == {
        "S0": ("EUR", "XPAR", 2.5, 2.0, 3.0, 1.0, 7, 10**12, T0),
        "S1": ("USD", "UNKNOWN", 0.0, 0.0, 0.0, 0.0, 9, 0, None),
        "S2": (None, None, 0.0, 0.0, 0.0, 0.0, 0, 0, None),
    }


def test_feature_files(spark, tmp_path):
    good = spark.createDataFrame([([1.5, 2.0], 1.0), ([3.0], 0.0)], "features array<float>, target float")
    good.coalesce(1).write.parquet(str(tmp_path / "a"))
    wide = spark.createDataFrame([([0.1], 1.0)], "features array<double>, target double")
    wide.coalesce(1).write.parquet(str(tmp_path / "a" / "deep" / "er"))
    spark.createDataFrame([(1,)], "other int").coalesce(1).write.parquet(str(tmp_path / "b"))
    whole = next((tmp_path / "a").glob("*.parquet")).read_bytes()
    (tmp_path / "cut.parquet").write_bytes(whole[: len(whole) // 2])
    df = read_feature_files(spark, str(tmp_path))
    assert df.dtypes == [("features", "array<float>"), ("target", "float")]
    got = sorted((len(r["features"]), round(r["features"][0], 3), r["target"]) for r in df.collect())
    assert got == [(1, 0.1, 1.0), (1, 3.0, 0.0), (2, 1.5, 1.0)]
    spark.createDataFrame([([0.1],)], "features array<float>").coalesce(1).write.parquet(str(tmp_path / "c d"))
    (tmp_path / "none.parquet").write_bytes(b"")
    told = {r.file.split(tmp_path.name)[1].split("/")[1]: r.reason for r in unreadable_files(spark, str(tmp_path)).collect()}
    assert set(told) == {"b", "c d", "cut.parquet", "none.parquet"}
    assert told["b"] == "no column features and no column target" and told["c d"] == "no column target"
    assert told["cut.parquet"].startswith("not readable") and told["none.parquet"].startswith("not readable")


def candle(symbol, price, minute=0):
    at = T0.replace(minute=minute)
    return (at, at.replace(minute=minute + 1), symbol, price, price, price, 0.5, 10, 1, 0.1, T0)


@pytest.fixture
def lake(spark, tmp_path):
    return Tables(spark, TickConfig(base_path=str(tmp_path / "lake")))


def test_bootstrap_and_empty_reads(spark, lake):
    assert not lake.exists("gold")
    assert lake.bootstrap("gold") and not lake.bootstrap("gold")
    assert lake.read("gold").count() == 0
    assert set(lake.read("gold").columns) == set(GOLD.names)
    lake.append("gold", spark.createDataFrame([candle("A", 1.0)], GOLD))
    assert not lake.bootstrap("gold")
    assert lake.read("gold").count() == 1


def test_numeric_symbol_stays_text(spark, lake):
    lake.append("gold", spark.createDataFrame([candle("7203", 1.0)], GOLD))
    row = lake.read("gold").first()
    assert row["symbol"] == "7203"
    assert dict(lake.read("gold").dtypes) == {f.name: f.dataType.simpleString() for f in TABLES["gold"]}


def test_schema_growth(spark, lake):
    older = spark.createDataFrame([candle("A", 1.0)], GOLD).drop("gold_computed_at")
    lake.append("gold", older)
    lake.append("gold", spark.createDataFrame([candle("A", 2.0, 1)], GOLD))
    assert {r["avg_price"]: r["gold_computed_at"] for r in lake.read("gold").collect()} == {1.0: None, 2.0: T0}


def test_views_and_sql(spark, lake):
    lake.append("gold", spark.createDataFrame([candle("A", 1.0), candle("A", 2.0, 1), candle("B", 5.0)], GOLD))
    assert lake.create_views() == ["gold"]
    assert {r["col_name"]: r["data_type"] for r in lake.describe("gold").collect()}["avg_price"] == "double"
    result = run_sql(spark, "SELECT symbol, avg(avg_price) AS m FROM gold GROUP BY symbol ORDER BY symbol DESC")
    assert [tuple(r) for r in result.rows()] == [("B", 5.0), ("A", 1.5)] and result.error is None
    paged = run_sql(spark, "SELECT * FROM gold WHERE symbol = :s", args={"s": "A"})
    assert (len(paged.page(1)), len(list(paged.rows()))) == (1, 2)
    failed = run_sql(spark, "SELECT nothing FROM gold")
    assert "nothing" in failed.error and failed.frame is None


def test_symbol_filter_prunes_partitions(spark, lake):
    lake.append("gold", spark.createDataFrame([candle("A", 1.0), candle("B", 5.0)], GOLD))
    picked = serving.of_symbol(lake.read("gold"), "A'; DROP TABLE gold; --")
    assert picked.count() == 0
    plan = serving.of_symbol(lake.read("gold"), "A").select("avg_price")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan
    assert "ReadSchema: struct<avg_price:double>" in plan
