"""Whitening of embeddings: exact moments by Spark, leading components by contour integration, projection by Spark.

Entries become integers (``floor(scale * c) + offset``), so sums and products are exact whatever the order they meet in:

1. Number of vectors and sums per dimension; each task adds up its rows and hands over one row per dimension.
2. Products of entries centred on the whole part of the mean, one row per task and pair of dimensions. What the centring
   leaves over is taken off exactly, in integers.
3. The covariance, a matrix of dimensions by dimensions, gives the components (``feast``), on the driver: its size does not
   depend on the number of rows.
4. Rows are projected, and the covariance of what came out is measured.

Defined cases: rows whose vector is null, empty, or holds null, NaN or infinite entries, or entries whose integer has more than
62 bits, are left out, and so are vectors of another length than the commonest (ties: the longest). Repeated rows count as
often as they occur, ids are handed through, nulls included. Components without variance (to rounding) do not exist: a table
without rows, or of equal rows, gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import stage

from .feast import leading

_LIMIT = float(1 << 62)
_LIMB = 10**18
_LONGEST = 10**38


@dataclass(frozen=True)
class Whitening:
    components: int = 8
    scale: int = 1024
    offset: int = 100_000
    #: variance below this share of the total is rounding
    least_share: float = 1e-13


@dataclass(frozen=True)
class Fitted:
    """What was fitted: exact counts and sums, and the components as columns, by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: list[float]


def usable(rows: DataFrame, vector: str, how: Whitening) -> DataFrame:
    """The rows with a whole vector, which is cast to doubles."""
    entries = F.col(vector).cast("array<double>")
    whole = F.forall(entries, lambda c: F.coalesce(F.abs(c * how.scale) < F.lit(_LIMIT), F.lit(False)) & ~F.isnan(c))
    return rows.withColumn(vector, entries).where(F.col(vector).isNotNull() & (F.size(vector) > 0)).where(whole)


def integers(column: pa.Array, dims: int, how: Whitening) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    return np.floor(how.scale * flat).astype(np.int64) + how.offset


def _decimals(values: list[int]) -> pa.Array:
    """Null for more than 38 digits."""
    return pa.array([str(v) if abs(v) < _LONGEST else None for v in values], pa.string()).cast(pa.decimal128(38, 0))


def _limbs(values: np.ndarray) -> list[pa.Array]:
    """Numbers of any length as ``high * _LIMB + low``; both parts can be summed."""
    return [_decimals(list(values // _LIMB)), _decimals(list(values % _LIMB))]


def _moments(dims: int, how: Whitening) -> Callable:
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(dims, object)
        for batch in batches:
            x = integers(batch.column(0), dims, how)
            n += len(x)
            wide = len(x) and int(np.abs(x).max()) * len(x) >= 1 << 62
            sums = sums + (x.astype(object) if wide else x).sum(axis=0).astype(object)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dims), pa.int32()), pa.array(np.full(dims, n)), _decimals(list(sums))], ["i", "n", "total"]
            )

    return add_up


def _exact_products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` without rounding."""
    bound = int(np.abs(y).max(initial=0)) ** 2 * len(y)
    if bound < 1 << 53:
        return (y.astype(float).T @ y.astype(float)).astype(np.int64)
    return y.T @ y if bound < 1 << 62 else y.astype(object).T @ y.astype(object)


def _products(dims: int, centre: np.ndarray, how: Whitening) -> Callable:
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((dims, dims), object), False
        for batch in batches:
            total = total + _exact_products(integers(batch.column(0), dims, how) - centre).astype(object)
            seen = seen or batch.num_rows > 0
        if seen:
            i, j = np.triu_indices(dims)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *_limbs(total[i, j])], ["i", "j", "high", "low"]
            )

    return add_up


def _dimensions(rows: DataFrame, vector: str) -> int:
    lengths = rows.groupBy(F.size(vector).alias("size")).count()
    first = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    return first["size"] if first else 0


def fit(rows: DataFrame, vector: str, dims: int, how: Whitening) -> Fitted:
    """Components of the covariance of all ``rows``, which have to be ``usable`` and of one length."""
    only = rows.select(vector)
    moments = only.mapInArrow(_moments(dims, how), "i int, n long, total decimal(38,0)")
    by_dim = {r.i: (r.n, int(r.total)) for r in moments.groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()}
    n, sums = by_dim[0][0], [by_dim[i][1] for i in range(dims)]
    centre = [s // n for s in sums]
    left = [s - n * c for s, c in zip(sums, centre)]
    products = only.mapInArrow(_products(dims, np.array(centre, np.int64), how), "i int, j int, high decimal(38,0), low decimal(38,0)")
    covariance = np.zeros((dims, dims))
    for r in products.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect():
        total = int(r.high) * _LIMB + int(r.low)
        # exact up to this division
        covariance[r.i, r.j] = covariance[r.j, r.i] = (n * total - left[r.i] * left[r.j]) / (n * n)
    trace = float(np.trace(covariance))
    values, vectors = leading(covariance, how.components, how.least_share * trace) if trace > 0 else (np.zeros(0), np.zeros((dims, 0)))
    return Fitted(n, sums, values, vectors, [float(v) / trace for v in values])


def project(rows: DataFrame, key: str, vector: str, model: Fitted, how: Whitening) -> DataFrame:
    """``key, deviation decimal(38,0), whitened array<double>``: the squared distance from the mean, times ``n`` squared,
    and the coordinates along the components, each of variance one. The distance is null beyond 38 digits."""
    dims, n = len(model.sums), model.n
    centre = np.array([s // n for s in model.sums], np.int64)
    left = np.array([s % n for s in model.sums], object)
    fraction = np.array([float(r) / n for r in left])
    axes = model.vectors / np.sqrt(model.values)
    square = int((left * left).sum())
    large = max(int(r) for r in left)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = integers(batch.column(1), dims, how) - centre
            bound = int(np.abs(y).max(initial=0))
            narrow = bound * max(bound, large) * dims < 1 << 62
            exact = y if narrow else y.astype(object)
            squares = (exact * exact).sum(axis=1).astype(object)
            crossed = (exact * (left.astype(np.int64) if narrow else left)).sum(axis=1).astype(object)
            deviation = n * n * squares - 2 * n * crossed + square
            flat = pa.array(((y - fraction) @ axes).ravel())
            offsets = pa.array(np.arange(len(y) + 1, dtype=np.int32) * axes.shape[1])
            whitened = pa.ListArray.from_arrays(offsets, flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), _decimals(list(deviation)), whitened], [key, "deviation", "whitened"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, vector).mapInArrow(run, f"`{key}` {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(projected: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    one = projected.agg(*(F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(one[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", how: Whitening | None = None) -> tuple[DataFrame, Fitted | None]:
    """``key, deviation, whitened`` per usable row, and the fitted components; no rows and None where there is
    nothing to fit."""
    how = how or Whitening()
    good = usable(rows.select(key, vector), vector, how)
    dims = _dimensions(good, vector)
    good = good.where(F.size(vector) == dims)
    model = fit(good, vector, dims, how) if dims else None
    if model is None or not len(model.values):
        kind = rows.schema[key].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"`{key}` {kind}, deviation decimal(38,0), whitened array<double>"), None
    return stage(project(good, key, vector, model, how), "whitened"), model


def component_rows(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", how: Whitening | None = None) -> DataFrame:
    """One row per usable vector and component, with the share of the variance and the measured error."""
    out, model = whitened(rows, key, vector, how)
    shares = model.explained if model else [0.0]
    error = identity_error(out, len(shares)) if model else 0.0
    return out.select(key, "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        key,
        (F.col("place") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*(F.lit(s) for s in shares))[F.col("place")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
