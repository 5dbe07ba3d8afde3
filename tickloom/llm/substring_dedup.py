"""Removal of repeated byte strings, by sampled suffixes and names.

A byte goes if some string of ``LENGTH`` bytes that covers it also starts elsewhere in the corpus. As in
difference-cover suffix sorting, suffixes are compared at sampled places only, names stand for their
beginnings, and the remaining suffixes are settled from the samples' names. Two choices differ
from the textbook form:

* The sample is content-defined: every string of LENGTH bytes samples the place of the smallest hash of
  the GRAM-byte strings in it. Equal strings hold the same sample at the same distance, which is what a
  difference cover guarantees, at one place in about seventy bytes instead of two in three.
* A name is the hash of the bytes it stands for, so equal names are found by grouping instead of sorting.

The length of the longest repeat starting at a place falls by at most one from each place to the next. So if a
longer string around several starts is repeated, all their strings are; if the bytes common to their
strings are not, none is. Starts with the same sample are settled together by these two tests, and only where
neither decides are they split: whole runs, blocks of BLOCK starts, single starts. Of the places
that hold a repeated name the first stays in play: it stands for the others when a part of
them is looked for.

Equal texts are one text with a number of copies: a text with copies goes whole if it is long enough.

Defined cases: null reads as empty. Texts shorter than LENGTH are never touched. Rows with the same id or the same
text are separate occurrences. Strings never cross rows. Other columns are not read. Names and text
digests are 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import stage

from .words import gram_range_hashes, grouped_rows, prefix_hash, range_hash, text_buffers

LENGTH = 200
GRAM = 50
BLOCK = 8
_SPAN = LENGTH - GRAM + 1


@dataclass
class Runs:
    """Starts ``low`` to ``high`` (both included) of strings with the sample at ``sample``."""

    low: np.ndarray
    high: np.ndarray
    sample: np.ndarray


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` values from each place on, with running minima of blocks."""
    size = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:size], ahead[width - 1 : width - 1 + size])


def runs_of(total: np.ndarray, bounds: np.ndarray) -> Runs:
    """Runs of all texts whose bytes lie between ``bounds``; ``total`` is their prefix hash."""
    size = len(total) - 1
    if size < LENGTH:
        return Runs(*(np.zeros(0, np.int64),) * 3)
    # the place decides between equal hashes, so the first of them is the sample
    keys = gram_range_hashes(total, GRAM)
    keys &= np.uint64(0xFFFFFFFF00000000)
    keys |= np.arange(len(keys), dtype=np.uint64)
    sample = (sliding_least(keys, _SPAN) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.zeros(size - LENGTH + 2, np.int64)
    fits = bounds[1:] - bounds[:-1] >= LENGTH
    np.add.at(inside, bounds[:-1][fits], 1)
    np.add.at(inside, bounds[1:][fits] - LENGTH + 1, -1)
    valid = np.cumsum(inside[:-1]) > 0
    # strings of two texts are never neighbours: a text's last starts are not valid
    change = sample[1:] != sample[:-1]
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | change
    ends = valid.copy()
    ends[:-1] &= ~valid[1:] | change
    low = np.flatnonzero(begins)
    return Runs(low, np.flatnonzero(ends), sample[low])


@dataclass
class Hits:
    """Indexes of the names found elsewhere too, and which of those places is the name's first."""

    at: np.ndarray
    first: np.ndarray

    def flags(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        found, first = np.zeros(size, bool), np.zeros(size, bool)
        found[self.at] = True
        first[self.at[self.first == 1]] = True
        return found, first


class Text:
    """One text on its way through the rounds. Each round turns what is open into names, and
    the names' indexes that turned out to be repeated into settled starts and open rest."""

    def __init__(self, raw: np.ndarray):
        self.size = len(raw)
        self.total = prefix_hash(raw)
        self.runs = runs_of(self.total, np.array([0, self.size]))
        self.low, self.high = [], []

    def names(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return range_hash(self.total, starts, ends)

    def settle(self, low: np.ndarray, high: np.ndarray) -> None:
        self.low.append(low)
        self.high.append(high)

    def open_runs(self, hit: Hits) -> Runs:
        """Runs whose sample is repeated."""
        r, at = self.runs, hit.at
        return Runs(r.low[at], r.high[at], r.sample[at])

    def run_names(self, runs: Runs) -> np.ndarray:
        return self.names(runs.low, runs.high + LENGTH)

    def blocks(self, runs: Runs, hit: Hits) -> Runs:
        """Blocks of starts by distance from the sample, of the runs not repeated as a whole and of
        the first of each that is."""
        whole, first = hit.flags(len(runs.low))
        self.settle(runs.low[whole], runs.high[whole])
        rest = first | ~whole
        low, high, sample = runs.low[rest], runs.high[rest], runs.sample[rest]
        first, last = (sample - high) // BLOCK, (sample - low) // BLOCK
        count = last - first + 1
        run = np.repeat(np.arange(len(low)), count)
        no = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + first[run]
        s = sample[run]
        return Runs(np.maximum(low[run], s - no * BLOCK - BLOCK + 1), np.minimum(high[run], s - no * BLOCK), s - no * BLOCK)

    def block_names(self, blocks: Runs) -> tuple[np.ndarray, np.ndarray]:
        """Names of what all strings of a block cover together, and of what those of a whole block
        have in common; ``sample`` holds the last start of the whole block."""
        together = self.names(blocks.low, blocks.high + LENGTH)
        return together, self.names(blocks.sample, blocks.sample - BLOCK + 1 + LENGTH)

    def singles(self, blocks: Runs, hit: Hits) -> np.ndarray:
        n = len(blocks.low)
        found, first = hit.flags(2 * n)
        together, core = found[:n], found[n:]
        self.settle(blocks.low[together], blocks.high[together])
        rest = np.where(together, first[:n], core)
        count = (blocks.high - blocks.low + 1)[rest]
        return np.repeat(blocks.low[rest], count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)

    def spans(self, singles: np.ndarray, hit: Hits) -> list[tuple[int, int]]:
        """Maximal removed runs of bytes."""
        self.settle(singles[hit.at], singles[hit.at])
        low, high = np.concatenate(self.low), np.concatenate(self.high)
        marks = np.zeros(self.size + 1, np.int64)
        np.add.at(marks, low, 1)
        np.add.at(marks, high + LENGTH, -1)
        gone = np.concatenate([[False], np.cumsum(marks[:-1]) > 0, [False]])
        edges = np.flatnonzero(gone[1:] != gone[:-1])
        return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _hits(column: pa.Array, row: int) -> Hits:
    found = np.sort(np.array(column[row].as_py() or [], np.int64))
    return Hits(found >> 1, found & 1)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of all samples, in order, per text."""
    for batch in batches:
        raw, offsets = text_buffers(batch.column(1))
        for start, stop in grouped_rows(offsets):
            piece, bounds = raw[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
            total = prefix_hash(piece)
            runs = runs_of(total, bounds)
            names = range_hash(total, runs.sample, runs.sample + GRAM).view(np.int64)
            borders = np.searchsorted(runs.low, bounds)
            kept = np.flatnonzero(np.diff(borders))
            cuts = pa.array(np.append(borders[kept], len(names)).astype(np.int32))
            ids = batch.column(0).slice(start, stop - start).take(pa.array(kept))
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(cuts, pa.array(names))], ["digest", "names"])


def _round(level: int) -> Callable:
    """Names to look up in a round and where their bytes begin, from the text and the hits of the
    rounds before."""

    def asked(text: Text, hits: list[Hits]) -> tuple[np.ndarray, np.ndarray]:
        runs = text.open_runs(hits[0])
        if level == 2:
            return text.run_names(runs), runs.low
        blocks = text.blocks(runs, hits[1])
        if level == 3:
            together, core = text.block_names(blocks)
            return np.concatenate([together, core]), np.concatenate([blocks.low, blocks.sample])
        singles = text.singles(blocks, hits[2])
        return text.names(singles, singles + LENGTH), singles

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            names, starts = [], []
            for i in range(batch.num_rows):
                hits = [_hits(batch.column(f"hit{k}"), i) for k in range(1, level)]
                n, s = asked(Text(raw[offsets[i] : offsets[i + 1]]), hits)
                names.append(n.view(np.int64).tolist())
                starts.append(s.tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(names, pa.list_(pa.int64())), pa.array(starts, pa.list_(pa.int32()))],
                ["digest", "names", "starts"],
            )

    return run


def _result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = text_buffers(batch.column("text"))
        out = []
        for i in range(batch.num_rows):
            text = Text(raw[offsets[i] : offsets[i + 1]])
            blocks = text.blocks(text.open_runs(_hits(batch.column("hit1"), i)), _hits(batch.column("hit2"), i))
            singles = text.singles(blocks, _hits(batch.column("hit3"), i))
            spans = text.spans(singles, _hits(batch.column("hit4"), i))
            keep = np.ones(text.size, bool)
            for a, b in spans:
                keep[a:b] = False
            rest = hashlib.sha256(raw[offsets[i] : offsets[i + 1]][keep].tobytes()).hexdigest()
            out.append((sum(b - a for a, b in spans), [{"start": a, "stop": b} for a, b in spans], rest))
        kinds = pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.string()
        yield pa.RecordBatch.from_arrays(
            [batch.column("digest"), *(pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 3, kinds))],
            ["digest", "n_removed", "spans", "kept_sha256"],
        )


NAMES = "digest long, names array<long>, starts array<int>"


def _repeated_samples(names: DataFrame) -> DataFrame:
    """Per text, ``2 * index`` of its samples whose names stand elsewhere too. Every text comes once
    and every sample has a place of its own, so counting is enough."""
    each = names.select("digest", F.posexplode("names").alias("at", "name"))
    twice = each.groupBy("name").count().where("count > 1").select("name")
    hit = each.join(twice.hint("merge"), "name", "left_semi")
    return hit.groupBy("digest").agg(F.collect_list((F.col("at") * 2).cast("int")).alias("hit1"))


def _repeated(names: DataFrame) -> DataFrame:
    """Per text, ``2 * index`` of its names that also stand at another place, plus 1 at one of them. A name at very many
    places is reduced to two places in each task before it is shuffled."""
    each = names.select("digest", F.posexplode(F.arrays_zip("names", "starts")).alias("at", "x"))
    each = each.select("digest", "at", F.col("x.names").alias("name"), F.col("x.starts").alias("start"))
    # a place is where the bytes begin: two samples may lead to the same bytes
    place = F.xxhash64("digest", "start")
    twice = each.groupBy("name").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a != b").select("name", "a")
    hit = (F.col("at") * 2 + (place == F.col("a")).cast("int")).cast("int")
    return each.join(twice, "name").groupBy("digest").agg(F.collect_set(hit).alias("hit"))


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, spans`` (byte ranges) and ``kept_sha256``."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), body.alias("text"))
    rows = rows.withColumn("digest", F.xxhash64(F.md5(F.col("text").cast("binary")))).withColumn("n_bytes", F.octet_length("text").cast("long"))
    long_rows = rows.where(F.col("n_bytes") >= LENGTH).select("digest", "text")
    # each text once; the sampling and the join below share this shuffle
    texts = long_rows.groupBy("digest").agg(F.first("text").alias("text"))
    hit = _repeated_samples(texts.mapInArrow(_sampled, "digest long, names array<long>"))
    work = stage(texts.join(hit.hint("merge"), "digest"), "texts")
    for level in (2, 3, 4):
        names = stage(work.mapInArrow(_round(level), NAMES), "names")
        found = _repeated(names).withColumnRenamed("hit", f"hit{level}")
        work = work.join(found, "digest", "left")
        if level < 4:
            work = stage(work, "texts")
    spans = stage(work.mapInArrow(_result, "digest long, n_removed long, spans array<struct<start:long,stop:long>>, kept_sha256 string"), "spans")
    copies = rows.groupBy("digest").agg(F.count("*").alias("copies"))
    known = stage(copies.where("copies > 1").join(spans, "digest", "full").select("digest", "copies", "n_removed", "spans", "kept_sha256"), "known")
    each = rows.select("doc_id", "digest", "n_bytes", F.sha2(F.col("text").cast("binary"), 256).alias("whole"))
    joined = each.join(known, "digest", "left")
    gone = (F.col("n_bytes") >= LENGTH) & (F.coalesce("copies", F.lit(1)) > 1)
    zero, none = F.lit(0).cast("long"), F.array().cast("array<struct<start:long,stop:long>>")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(gone, F.array(F.struct(zero.alias("start"), F.col("n_bytes").alias("stop")))).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(gone, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    )
