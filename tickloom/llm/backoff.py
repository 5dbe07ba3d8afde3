"""Stupid-backoff language-model scores from n-gram count tables.

The score of a word is the relative frequency of the longest n-gram ending in it that the corpus
holds at least ``min_count`` times, times a factor for every shorter length it had to fall back to; a
document's score is the sum of the logarithms. Counts cover all documents.

Exploded n-grams of a whole corpus are too many rows to shuffle one by one, so documents are put
into chunks by a hash of their id, and a chunk contributes each distinct n-gram once, with its count:

1. Chunk -> (order, hash bucket): sorted distinct n-gram hashes and their counts in the chunk.
2. Bucket: the n-gram table of that range of hashes; each chunk gets the totals of its own n-grams back.
3. Chunk: its n-grams joined with the totals, summed per document.

A frequent n-gram is one entry per chunk, so no bucket is hot. Buckets grow in number with the corpus, and
hold about as much as a chunk. The texts are shuffled once; both uses share the exchange.

Defined cases: null and empty texts have no words, the score 0 and no mean. Repeated rows count as often as they
occur. Ids are handed through, nulls included. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import stage

from .words import WHITE, Tokenizer, Words, gram_hashes, gram_starts, text_buffers

CHUNK_BYTES = 4 << 20
_SPLIT = Tokenizer(frozenset(range(256)) - WHITE, lower=False)


@dataclass(frozen=True)
class Backoff:
    order: int = 2
    factor: float = 0.4
    min_count: int = 2


def pack(values: np.ndarray) -> bytes:
    """Byte planes of 64-bit numbers: planes of zeros vanish when the shuffle compresses."""
    return np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


@dataclass
class Grams:
    """Distinct n-grams of a chunk, and for every place where one ends its index among them."""

    values: np.ndarray
    counts: np.ndarray
    ends: np.ndarray
    index: np.ndarray


def chunk_words(column: pa.ChunkedArray) -> Words:
    raw, offsets = text_buffers(column)
    return _SPLIT.split(raw, offsets, 0, len(offsets) - 1)


def grams_of(words: Words, n: int) -> Grams:
    starts = np.flatnonzero(gram_starts(words.first, n))
    values, index, counts = np.unique(gram_hashes(words.hashes, n)[starts], return_inverse=True, return_counts=True)
    return Grams(values, counts, starts + n - 1, index)


def bucket_borders(values: np.ndarray, bits: int) -> np.ndarray:
    return np.searchsorted(values >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))


def word_scores(words: Words, totals: list[np.ndarray], grams: list[Grams], how: Backoff) -> tuple[np.ndarray, np.ndarray]:
    """Per word: the logarithm without the corpus size, and whether that size is still to be divided by."""
    size = len(words.hashes)
    place = np.arange(size)
    counts = []
    for total, g in zip(totals, grams):
        c = np.zeros(size)
        c[g.ends] = total[g.index]
        counts.append(c)
    logs = np.log(np.maximum(counts[0], 1.0))
    whole = np.ones(size, bool)
    # words before this one in its text bound the longest length there is
    longest = np.minimum(place - np.repeat(words.first[:-1], words.counts) + 1, how.order)
    used = np.ones(size, np.int64)
    for n in range(2, how.order + 1):
        hit = counts[n - 1] >= how.min_count
        context = counts[n - 2][np.maximum(place - 1, 0)]
        logs[hit] = np.log(counts[n - 1][hit]) - np.log(context[hit])
        whole[hit] = False
        used[hit] = n
    return logs + (longest - used) * math.log(how.factor), whole


def scored(docs: DataFrame, how: Backoff | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, log_score, mean_log_score`` per row."""
    how = how or Backoff()
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    total_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_chunks = max(1, math.ceil(total_bytes / CHUNK_BYTES))
    bits = max(3, math.ceil(math.log2(n_chunks)))
    chunked = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(n_chunks)).cast("int"))

    def split(table: pa.Table) -> pa.Table:
        words, chunk = chunk_words(table.column("text")), table.column("chunk")[0].as_py()
        out: list[tuple] = []
        for n in range(1, how.order + 1):
            grams = grams_of(words, n)
            borders = bucket_borders(grams.values, bits)
            for b, (i, j) in enumerate(zip(borders[:-1], borders[1:])):
                if i < j:
                    steps = np.diff(grams.values[i:j], prepend=np.uint64(0))
                    out.append((n, b, chunk, pack(steps), pack(grams.counts[i:j])))
        return pa.Table.from_arrays(
            [pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 5, (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
            ["n", "bucket", "chunk", "steps", "counts"],
        )

    def sum_up(table: pa.Table) -> pa.Table:
        values = [np.cumsum(unpack(x.as_py()), dtype=np.uint64) for x in table.column("steps")]
        counts = np.concatenate([unpack(x.as_py()) for x in table.column("counts")])
        borders = np.cumsum([len(v) for v in values])[:-1]
        _, index = np.unique(np.concatenate(values), return_inverse=True)
        totals = np.bincount(index, counts).astype(np.uint64)[index]
        packed = [pack(t) for t in np.split(totals, borders)]
        return table.select(["n", "bucket", "chunk"]).append_column("totals", pa.array(packed, pa.binary()))

    def score(texts: pa.Table, totals: pa.Table) -> pa.Table:
        words = chunk_words(texts.column("text"))
        grams = [grams_of(words, n) for n in range(1, how.order + 1)]
        parts: dict[int, list] = {n: [] for n in range(1, how.order + 1)}
        for n, b, t in zip(*(totals.column(c).to_pylist() for c in ("n", "bucket", "totals"))):
            parts[n].append((b, unpack(t)))
        sums = [np.concatenate([t for _, t in sorted(parts[n], key=lambda x: x[0])] or [np.zeros(0)]).astype(float) for n in parts]
        logs, whole = word_scores(words, sums, grams, how)
        owner, size = words.owner, len(words.rows)
        return pa.Table.from_arrays(
            [
                texts.column("doc_id"),
                pa.array(words.counts, pa.int64()),
                pa.array(np.bincount(owner, logs, minlength=size).astype(float)),
                pa.array(np.bincount(owner, whole, minlength=size).astype(np.int64)),
            ],
            ["doc_id", "n_words", "logs", "n_single"],
        )

    counted = chunked.groupBy("chunk").applyInArrow(split, "n int, bucket int, chunk int, steps binary, counts binary")
    totals = counted.groupBy("n", "bucket").applyInArrow(sum_up, "n int, bucket int, chunk int, totals binary")
    joined = chunked.groupBy("chunk").cogroup(totals.groupBy("chunk"))
    sums = stage(joined.applyInArrow(score, f"doc_id {kind}, n_words long, logs double, n_single long"), "scores")
    size = sums.agg(F.sum("n_words")).first()[0] or 1
    log_score = F.col("logs") - F.col("n_single") * math.log(max(size, 1))
    return sums.select(
        "doc_id", "n_words", log_score.alias("log_score"), F.when(F.col("n_words") > 0, log_score / F.col("n_words")).alias("mean_log_score")
    )
