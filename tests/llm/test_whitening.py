"""Whitening against plain numpy, and the eigen solver on hard spectra."""

import math

import numpy as np
import pytest

from tickloom.llm.feast import count_above, leading
from tickloom.llm.whitening import Whitening, component_rows, whitened

SCHEMA = "vec_id long, embedding array<float>, label int, deviation string, i int"


def table(spark, vectors):
    return spark.createDataFrame([(k, v, 1, "own", 3) for k, v in vectors], SCHEMA).repartition(3)


def expected(vectors, components=8):
    x = np.floor(1024 * np.array(vectors, np.float32).astype(float)) + 100_000
    centred = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(x))
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return x, values, centred @ axes / np.sqrt(values)


def test_equals_dense_eigenvectors(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((300, 20)) * rng.uniform(0.1, 2, 20)).tolist()
    x, values, want = expected(vectors)
    rows = component_rows(table(spark, list(enumerate(vectors)))).collect()
    assert len(rows) == 300 * 8 and {r.n for r in rows} == {300}
    got = np.zeros((300, 8))
    for r in rows:
        got[r.vec_id, r.component - 1] = r.whitened
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got * signs - want).max() < 1e-9
    share = {r.component: r.explained for r in rows}
    total = np.trace(np.cov(x.T, bias=True))
    assert all(abs(share[k + 1] - v / total) < 1e-12 for k, v in enumerate(values))
    assert {r.identity_error < 1e-9 for r in rows} == {True}
    sums = [int(s) for s in x.sum(axis=0)]
    for r in rows[:40]:
        assert int(r.deviation) == sum((300 * int(v) - s) ** 2 for v, s in zip(x[r.vec_id], sums))


def test_odd_vectors(spark):
    rng = np.random.default_rng(4)
    good = [(k % 7, v) for k, v in enumerate(rng.standard_normal((30, 3)).tolist())] + [(None, [0.5, 0.25, -1.0])] * 2
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [1.0, float("nan"), 2.0]), (94, [math.inf, 1.0, 2.0]), (95, [1.0, 2.0]), (96, [3e38, 0.0, 0.0])]
    rows = component_rows(table(spark, good + bad)).collect()
    assert {r.component for r in rows} == {1, 2, 3} and {r.n for r in rows} == {32}
    assert len(rows) == 32 * 3 and sum(r.vec_id is None for r in rows) == 6
    assert not {r.vec_id for r in rows} & set(range(90, 97))


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [1.0, 2.0])] * 5])
def test_nothing_to_fit(spark, vectors):
    out = component_rows(table(spark, vectors))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.count() == 0


def test_sums_beyond_64_bits_stay_exact(spark):
    vectors = [(k, [k * 8e14, 1.0 - k, k * k * 1e10]) for k in range(6)]
    rows = {r.vec_id: r for r in whitened(table(spark, vectors), how=Whitening(components=1))[0].collect()}
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in vectors]
    sums = [sum(column) for column in zip(*x)]
    want = {k: sum((6 * c - s) ** 2 for c, s in zip(v, sums)) for k, v in enumerate(x)}
    assert max(want.values()) > 10**38 > min(want.values()) > 10**20
    assert {k: r.deviation and int(r.deviation) for k, r in rows.items()} == {k: d if d < 10**38 else None for k, d in want.items()}


def rotated(values, seed=5):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    v = (q * np.array(values, float)) @ q.T
    return (v + v.T) / 2


@pytest.mark.parametrize(
    "spectrum",
    [[9, 7, 5, 3, 1], [5] * 6 + [4, 3, 3, 3] + [1] * 20, [1e4, 1, 1e-3] + [1e-6] * 9, list(np.linspace(1, 1.001, 40)), [2] * 12, [1, 0, 0, 0]],
)
def test_no_component_is_missed(spectrum):
    matrix = rotated(spectrum)
    wanted = min(8, sum(v > 0 for v in spectrum))
    values, vectors = leading(matrix, wanted, 1e-13 * sum(spectrum))
    assert len(values) == wanted
    assert np.allclose(values, sorted(spectrum, reverse=True)[:wanted], atol=1e-12 * max(spectrum))
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-13
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-13 * max(spectrum)


def test_inertia():
    matrix = rotated([4, 3, 2, 0, -1, -1, 7])
    assert [count_above(matrix, s) for s in (-2, -0.5, 0.5, 2.5, 3.5, 5, 8)] == [7, 5, 4, 3, 2, 1, 0]
    assert count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
