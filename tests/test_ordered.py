"""Sliced lag, lead and percent_rank against plain windows over the whole key."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.operators.ordered import PART, Slices

START = datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for i in range(3000):
        # one symbol holds most rows, and one minute of it most of those
        symbol = rng.choice(["hot", "hot", "hot", "b", "c", None])
        at = START + timedelta(seconds=rng.choice([7, 7, 7, rng.randrange(200_000)]))
        value = rng.choice([None, rng.randrange(100)])
        data.append((i, symbol, rng.choice([at, at, at, None]) if i % 50 == 0 else at, value))
    return spark.createDataFrame(data, "id bigint, symbol string, at timestamp, v int").repartition(5).cache()


def expected(rows):
    w = Window.partitionBy("symbol").orderBy("at", "id")
    return rows.select(
        "id",
        F.lag("v").over(w).alias("before"),
        F.lead("v").over(w).alias("after"),
        F.percent_rank().over(w).alias("share"),
    )


@pytest.mark.parametrize("max_rows", [10**6, 100])
@pytest.mark.parametrize("seconds", [60, 86400, 10**9])
def test_rows_match_plain_windows(rows, max_rows, seconds):
    cut = Slices.of_rows(rows, ["symbol"], ["at", "id"], seconds, carry=["v"], max_rows=max_rows)
    got = cut.lag("v", "before").lead("v", "after").percent_rank("share").frame()
    assert got.columns == ["id", "symbol", "at", "v", "before", "after", "share"]
    got = got.select("id", "before", "after", "share")
    want = expected(rows)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_slices_are_cut(rows):
    cut = Slices.of_rows(rows, ["symbol"], ["at", "id"], 10**9, carry=["v"], max_rows=100)
    sizes = [r["count"] for r in cut._df.groupBy("_key", "_slice", PART).count().collect()]
    assert sum(sizes) == rows.count()
    assert max(sizes) <= 300 < rows.where("symbol = 'hot'").count()


def test_steps_and_filter_between(spark):
    data = [("a", START + timedelta(minutes=i), i) for i in range(100)] + [("b", START, 5)]
    df = spark.createDataFrame(data, "symbol string, at timestamp, v int")
    cut = Slices.of_steps(df, ["symbol"], ["at"], 600)
    got = (
        cut.lag("v", "before").where(F.col("v") % 7 != 0).lead("v", "after").percent_rank("share").frame()
    )
    w = Window.partitionBy("symbol").orderBy("at")
    want = (
        df.withColumn("before", F.lag("v").over(w))
        .where(F.col("v") % 7 != 0)
        .withColumn("after", F.lead("v").over(w))
        .withColumn("share", F.percent_rank().over(w))
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("last_complete", [True, False])
def test_lead_and_share_is_lead_filter_rank(spark, last_complete):
    data = [(s, START + timedelta(minutes=i), i, i % 3 > 0) for s in "ab" for i in range(40)]
    data += [("a", START + timedelta(minutes=40), 40, last_complete), ("c", START, 1, True)]
    df = spark.createDataFrame(data, "symbol string, at timestamp, v int, ok boolean")
    cut = Slices.of_steps(df, ["symbol"], ["at"], 300)
    got = cut.lead_and_share("v", "after", F.col("ok"), "share").frame()
    w = Window.partitionBy("symbol").orderBy("at")
    kept = df.withColumn("after", F.lead("v").over(w)).where("ok AND after IS NOT NULL")
    want = kept.withColumn("share", F.percent_rank().over(w))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("length", [1, 2, 5, 40])
@pytest.mark.parametrize("seconds, max_rows", [(60, 10**6), (86400, 100), (10**9, 30)])
def test_rolling_values_match_a_plain_frame(rows, length, seconds, max_rows):
    cut = Slices.of_rows(rows, ["symbol"], ["at", "id"], seconds, carry=["v"], max_rows=max_rows)
    got = cut.rolling("v", length, "values").frame()
    assert got.columns == ["id", "symbol", "at", "v", "values"]
    frame = Window.partitionBy("symbol").orderBy("at", "id").rowsBetween(1 - length, 0)
    # a plain frame leaves nulls out
    want = rows.select("id", F.transform(F.collect_list(F.struct("v")).over(frame), lambda s: s["v"]).alias("values"))
    assert sorted(map(str, got.select("id", "values").collect())) == sorted(map(str, want.collect()))
