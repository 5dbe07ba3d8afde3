"""Means that depend on neither the order nor the size of the values."""

import random

import pytest
from pyspark.sql import functions as F

from tickloom.functions import exact_mean


@pytest.mark.parametrize(
    "values, want",
    [
        ([1e-7, 3e-7], 2e-7),
        ([9e12, 9e12, 9.3e12], 9.1e12),
        ([1e18] * 50, 1e18),
        ([0.1, 0.2, 0.3], 0.2),
        ([1 / 3, 2 / 3], 0.5),
        ([None, 4.0], 4.0),
        ([None], None),
    ],
)
def test_exact_mean(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.agg(exact_mean("x")).first()[0]
    assert got == (want if want is None else pytest.approx(want, rel=1e-15))


def test_any_order_gives_the_same_mean(spark):
    rng = random.Random(2)
    values = [(rng.uniform(-1e6, 1e6),) for _ in range(5000)]
    df = spark.createDataFrame(values, "x double")
    got = {df.repartition(n, F.rand(n)).agg(exact_mean("x"), exact_mean(F.round("x", 10), 10)).first() for n in (1, 3, 7, 11)}
    assert len(got) == 1
