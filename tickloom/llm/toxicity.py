"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct words, word pairs and pairs with one word between of a text, hashed into
``2**BITS`` places. The learner keeps a step size per coordinate and drives weights to zero by L1, so the
model is a short list of weights; its length is bounded by the number of places, so it may be
broadcast. It is fitted on a bounded sample of labelled rows (``max_rows``, taken in hash order) in one
task; scoring is one pass over all texts, without a shuffle.

Only texts and labels are read for fitting, and only the text for scoring.

Defined cases: null and empty texts have no features and score the model's base rate. Several labels of
one document count as toxic if one does; null labels are ignored. Without any labelled row of
both kinds every score is 0. Repeated document rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import stage

from .words import ALNUM_OR_WIDE, Tokenizer, Words, gram_hashes, gram_starts, mix, ragged_binary

BITS = 18
_SPLIT = Tokenizer(ALNUM_OR_WIDE, lower=True)


@dataclass(frozen=True)
class Ftrl:
    """``alpha`` and ``beta`` set the step sizes, ``l1`` and ``l2`` the penalties, ``positive`` the
    weight of a toxic row, ``passes`` how often the sample is gone through."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 16.0
    l2: float = 1.0
    positive: float = 3.0
    passes: int = 4
    max_rows: int = 16_000


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Places of all n-grams and skip-grams, and the index of the text each belongs to."""
    h, first = words.hashes, words.first
    owner = words.owner
    parts, owners = [h], [owner]
    pairs = gram_starts(first, 2)
    parts.append(gram_hashes(h, 2)[pairs])
    owners.append(owner[: len(pairs)][pairs])
    skips = gram_starts(first, 3)
    size = len(skips)
    parts.append(mix(h[:size] * np.uint64(3) + mix(h[2 : 2 + size]))[skips])
    owners.append(owner[:size][skips])
    places = np.concatenate(parts) >> np.uint64(64 - BITS)
    return places.astype(np.int64), np.concatenate(owners)


def distinct(places: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique((owners << BITS) | places)
    return keys & ((1 << BITS) - 1), keys >> BITS


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words in _SPLIT.groups(batch.column(2)):
            places, owners = distinct(*features(words))
            borders = np.searchsorted(owners, np.arange(len(words.rows) + 1))
            part = batch.slice(int(words.rows[0]), len(words.rows))
            packed = ragged_binary(places.astype(np.uint32), borders)
            yield pa.RecordBatch.from_arrays([*part.columns[:2], packed], ["order", "toxic", "places"])


def fit_rows(rows: list[tuple[np.ndarray, int]], how: Ftrl) -> tuple[np.ndarray, float]:
    """Weights and bias after ``how.passes`` over the rows, in the given order."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_n = 0.0

    def weight(z, n):
        return np.where(np.abs(z) <= how.l1, 0.0, -(z - np.sign(z) * how.l1) / ((how.beta + np.sqrt(n)) / how.alpha + how.l2))

    def bias() -> float:
        return -bias_z / ((how.beta + bias_n**0.5) / how.alpha)

    for _ in range(how.passes):
        for places, label in rows:
            w = weight(z[places], n[places])
            b = bias()
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + b, -35, 35)))
            g = (p - label) * (how.positive if label else 1.0)
            step = (np.sqrt(n[places] + g * g) - np.sqrt(n[places])) / how.alpha
            z[places] += g - step * w
            n[places] += g * g
            bias_step = ((bias_n + g * g) ** 0.5 - bias_n**0.5) / how.alpha
            bias_z += g - bias_step * b
            bias_n += g * g
    return weight(z, n), bias()


def fit(docs: DataFrame, labels: DataFrame, how: Ftrl | None = None, text: str = "text") -> tuple[np.ndarray, float] | None:
    """Fit on labelled rows ``(doc_id, toxic)``; None without rows of both labels."""
    how = how or Ftrl()
    spark = docs.sparkSession
    known = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = known.withColumn("order", order).orderBy("order", "doc_id").limit(how.max_rows)
    chosen = stage(chosen, "labelled")
    # one text per labelled id, whatever rows repeat it
    texts = docs.select("doc_id", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    texts = texts.join(chosen, "doc_id").groupBy("order", "doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    rows = stage(texts.select("order", "toxic", "text").mapInArrow(_featured, "order long, toxic int, places binary"), "featured")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        table.sort(key=lambda r: (r[0], r[2]))
        sample = [(np.frombuffer(r[2], np.uint32), r[1]) for r in table]
        if len({label for _, label in sample}) < 2:
            return
        weights, bias = fit_rows(sample, how)
        places = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *places.tolist()], pa.int64()), pa.array([bias, *weights[places].tolist()], pa.float64())],
            ["place", "weight"],
        )

    # a bounded sample: max_rows rows of distinct places, in one task
    model = stage(rows.coalesce(1).mapInArrow(learn, "place long, weight double"), "toxicity-model")
    found = model.collect()  # at most 2**BITS + 1 rows
    if not found:
        return None
    weights, bias = np.zeros(1 << BITS), 0.0
    for place, value in found:
        if place < 0:
            bias = value
        else:
            weights[place] = value
    return weights, bias


def scored(docs: DataFrame, model: tuple[np.ndarray, float] | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` for every row."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    weights, bias = model
    places = np.flatnonzero(weights)
    shared = docs.sparkSession.sparkContext.broadcast((places, weights[places], bias))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, base = shared.value
        full = np.zeros(1 << BITS)
        full[at] = values
        for batch in batches:
            for words in _SPLIT.groups(batch.column(1)):
                places, owners = features(words)
                live = full[places] != 0
                places, owners = distinct(places[live], owners[live])
                logits = base + np.bincount(owners, full[places], minlength=len(words.rows))
                part = batch.slice(int(words.rows[0]), len(words.rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(1.0 / (1.0 + np.exp(-np.clip(logits, -35, 35))), pa.float64())], ["doc_id", "score"]
                )

    return rows.mapInArrow(score, f"doc_id {kind}, score double")


def fold(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 5


def held_out_scores(docs: DataFrame, labels: DataFrame, how: Ftrl | None = None) -> DataFrame:
    """Scores of all documents by a model that has seen labels of folds 1 to 4 only."""
    model = fit(docs, labels.where(fold(F.col("doc_id")) != 0).select("doc_id", "toxic"), how)
    out = scored(docs, model)
    return out.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
