"""Benchmark decontamination by winnowing.

A window is ten consecutive words of a benchmark item (a shorter item is one window). Its
fingerprint is the smallest hash of the k-word grams inside it; equal windows have equal
fingerprints, and since every ten-word span of a document takes its minimum over the same number of
grams, every shared span of ten words meets on a fingerprint.

1. Benchmark: distinct windows with their fingerprint and the items they occur in.
2. Documents: one pass computes the fingerprint of every ten-word span and keeps the spans whose
   fingerprint is in a bitmap of the benchmark's fingerprints. The bitmap has a fixed number of bits
   whatever the benchmark's size (a full one costs time, never a hit). Shorter windows of length L are
   looked up as whole L-word spans in the same way.
3. The kept spans join the benchmark windows on fingerprint and words. Runs of hit spans extend
   over each other, and their union is counted.

Per document only its hits are grouped. A window that many documents share is a hot join key with one
row on the benchmark side, which adaptive execution splits on the documents' side.

Defined cases: null and empty texts have no words, no hits and count as clean. An item without words has
no window. Repeated item rows (same id and text) count once; each repeated document row is
returned. A null item id is left out of the list of items but its windows count as hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import stage

from .common import clear_of
from .words import ALNUM_OR_WIDE, Tokenizer, Words, gram_hashes, gram_starts

WINDOW = 10
GRAM = 5
BITMAP_BITS = 22
_SPLIT = Tokenizer(ALNUM_OR_WIDE, lower=True)
SPANS = "array<struct<start:long,size:int,print:long,words:string>>"


def span_prints(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all spans of ``size`` words within one text, and their fingerprints."""
    gram = min(GRAM, size)
    grams = gram_hashes(words.hashes, gram)
    count = max(0, len(words.hashes) - size + 1)
    least = grams[:count].copy()
    for k in range(1, size - gram + 1):
        np.minimum(least, grams[k : k + count], out=least)
    starts = np.flatnonzero(gram_starts(words.first, size))
    return starts, least[starts]


def span_text(words: Words, start: int, size: int) -> str:
    """The words of a span, lower-cased, with single spaces."""
    return " ".join(
        words.raw[words.starts[i] : words.ends[i]].tobytes().decode("utf-8", "replace")
        for i in range(start, start + size)
    )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words in _SPLIT.groups(batch.column(1)):
            out: list[tuple] = []
            for place, row in enumerate(words.rows):
                first, n = int(words.first[place]), int(words.counts[place])
                if not n:
                    continue
                size = min(n, WINDOW)
                one = Words(np.array([0]), np.array([0, n]), words.hashes[first : first + n],
                            words.starts[first : first + n], words.ends[first : first + n], words.raw)
                starts, prints = span_prints(one, size)
                item = batch.column(0)[int(row)].as_py()
                out += [(item, size, int(p), span_text(one, int(s), size)) for s, p in zip(starts, prints.view(np.int64))]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int32(), pa.int64(), pa.string()))],
                    ["item", "size", "print", "words"],
                )


def benchmark_windows(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """``(size, print, words, items)``: distinct windows, with the sorted ids of their items."""
    rows = benchmark.select(F.col(key).cast("string"), F.col(text).cast("string")).mapInArrow(
        _windows, "item string, size int, print long, words string"
    )
    return rows.groupBy("size", "print", "words").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _bucket(prints: np.ndarray) -> np.ndarray:
    return (prints.view(np.uint64) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _bitmap(windows: DataFrame) -> tuple[bytes, list[int]]:
    """Bitmap of the fingerprints' leading bits, and the window lengths: at most 2**BITMAP_BITS bits
    and WINDOW numbers reach the driver, for any benchmark."""
    taken = windows.select(F.shiftrightunsigned("print", 64 - BITMAP_BITS).alias("b")).distinct()
    bits = np.zeros(1 << BITMAP_BITS, bool)
    bits[[r.b for r in taken.toLocalIterator()]] = True
    return np.packbits(bits).tobytes(), sorted(r["size"] for r in windows.select("size").distinct().collect())


def document_spans(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """All columns of ``docs`` but its last, the text, plus ``n_words`` and the candidate spans."""
    packed, sizes = _bitmap(windows)
    shared = docs.sparkSession.sparkContext.broadcast(packed)
    names = docs.columns[:-1]

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(shared.value, np.uint8)).view(bool)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int32()), ("print", pa.int64()), ("words", pa.string())]))
        for batch in batches:
            for words in _SPLIT.groups(batch.column(len(names))):
                found: list[list] = [[] for _ in words.rows]
                for size in sizes:
                    starts, prints = span_prints(words, size)
                    keep = bits[_bucket(prints)]
                    starts, prints = starts[keep], prints[keep].view(np.int64)
                    owner = np.searchsorted(words.first, starts, side="right") - 1
                    for s, p, o in zip(starts.tolist(), prints.tolist(), owner.tolist()):
                        found[o].append((s - int(words.first[o]), size, p, span_text(words, s, size)))
                part = batch.slice(int(words.rows[0]), len(words.rows))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(words.counts, pa.int64()), pa.array(found, kind)],
                    [*names, "n_words", "spans"],
                )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields[:-1])
    return docs.mapInArrow(spans, f"{kept}, n_words long, spans {SPANS}")


def overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document row: ``doc_id, n_words, n_hit, items`` (sorted ids of the items with an occurring
    window) and ``contaminated``."""
    windows = stage(benchmark_windows(benchmark), "windows")
    rows = document_spans(docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")), windows)
    # written once with a row number: the number must not change when a task runs again
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "spans")
    spans = rows.select("row", F.inline("spans"))
    hits = spans.join(windows, ["size", "print", "words"]).select(
        "row", F.struct("start", (F.col("start") + F.col("size")).alias("stop")).alias("span"), "items"
    )
    begun = F.struct(F.lit(0).cast("long").alias("stop"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        F.sort_array(F.collect_set("span")),
        begun,
        lambda a, s: F.struct(
            F.greatest(a["stop"], s["stop"]).alias("stop"),
            (a["n"] + F.greatest(F.lit(0).cast("long"), s["stop"] - F.greatest(a["stop"], s["start"]))).alias("n"),
        ),
        lambda a: a["n"],
    )
    hits = hits.groupBy("row").agg(
        covered.alias("n_hit"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.join(hits, "row", "left").select(
        "row", "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that share no window with the benchmark. Rows with the same key and text
    share their fate; rows of one key with another text are judged by their own text."""
    (mark,) = clear_of(docs, "text_digest")
    marked = docs.withColumn(mark, F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256))
    bad = marked.select(F.col(mark).alias("doc_id"), F.col(text).alias("text"))
    bad = overlaps(bad, benchmark).where("contaminated").select(F.col("doc_id").alias(mark)).distinct()
    # as many as there are leaks: never a broadcast
    return marked.join(bad.hint("merge"), mark, "left_anti").select(*docs.columns)
