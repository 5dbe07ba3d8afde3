"""Collocations: phrases scored by the counts of their parts, from sorted streams of n-gram counts.

An n-gram is a key: its language and words, joined by a byte that sorts before all others, so that the order of keys is the
order of word sequences and an n-gram stands right before its extensions.

1. Runs. A task turns its texts into runs: sorted distinct n-grams of one length with their counts, cut into blocks. Runs are
   written to the shared folder.
2. Ranges. The first keys of the blocks are a regular sample of all n-grams; their quantiles split the keys into ranges that fit
   a task. Blocks are cut at the splitters.
3. Counts. Per range the blocks are merged into one sorted stream and the counts of equal keys added. N-grams below the least
   count go: a phrase is no more frequent than any of its parts, so they are part of no candidate. What is left is
   in prefix order; with the words turned round it is put in suffix order in the same way.
4. Lockstep. In prefix order the streams of one, two and three words run side by side: the last shorter n-gram passed is the
   first part of the one at hand (left counts), and the largest count among the extensions of a phrase is known when they have
   passed. Suffix order gives the right counts and the extensions to the left. A shorter n-gram is copied into every range
   that its extensions reach, so a frequent first word is no hot key.

Counts are found by sorting and merging; no n-gram is hashed to be counted.

Defined cases: null texts are empty, a null language is ``und`` (as one of that name). Repeated rows count as often as they occur.
A text longer than a run is cut behind a piece. Languages without candidates, and empty tables, give no rows. Other
columns, ids included, are not read.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.session import stage

from .words import text_buffers

_PIECE_END = np.isin(np.arange(256), list(b".,;:!?\n\x0b\x0c\r"))
_WORD = ~_PIECE_END & ~np.isin(np.arange(256), list(b" \t"))
# lower case; bytes 0 to 8 move up by one, which frees the byte 0 and keeps their order (9, the tabulator, is in no word)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_FOLD[:9] += 1
_UNFOLD = bytes([0, *range(9), *range(10, 256)])
_JOIN = b"\0"

_AT_ONCE = 64

RUN = "n int, first binary, last binary, lengths binary, keys binary, counts binary"


@dataclass(frozen=True)
class Collocations:
    longest: int = 3
    least: int = 10
    scale: int = 1_000_000
    #: a phrase goes if a longer one around it has at least this percentage of its count
    inside_percent: int = 50
    top: int = 2000
    run_bytes: int = 3 << 20
    block: int = 4096
    per_range: int = 700_000
    #: bound of the sample of block keys on the driver
    sampled: int = 200_000


# --- runs ----------------------------------------------------------------------------------------


def _cuts(raw: np.ndarray, offsets: np.ndarray, size: int) -> list[int]:
    """Places that cut a batch into parts of about ``size`` bytes: between texts, or behind a piece of a longer one."""
    cuts = [int(offsets[0])]
    end = int(offsets[-1])
    while cuts[-1] < end:
        at = cuts[-1]
        if end - at <= size:
            cuts.append(end)
            break
        border = int(offsets[np.searchsorted(offsets, at + size, side="right") - 1])
        if border <= at:
            stop = int(offsets[np.searchsorted(offsets, at, side="right")])
            inside = np.flatnonzero(_PIECE_END[raw[at : at + size]])
            if len(inside):
                border = at + int(inside[-1]) + 1
            else:
                # one piece longer than a run
                border = next((p + 1 for p in _piece_ends(raw, at + size, stop, size)), stop)
        cuts.append(border)
    return cuts


def _piece_ends(raw: np.ndarray, start: int, stop: int, step: int) -> Iterator[int]:
    for at in range(start, stop, step):
        inside = np.flatnonzero(_PIECE_END[raw[at : min(at + step, stop)]])
        if len(inside):
            yield at + int(inside[0])


def _joined(parts: list[pa.Array]) -> pa.Array:
    return pc.binary_join_element_wise(*parts, pa.scalar(_JOIN, pa.large_binary()))


def _ngrams(raw: np.ndarray, borders: np.ndarray, langs: pa.Array, longest: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Sorted distinct keys and counts per length. ``borders`` are where the texts end; ``langs`` has one entry per text."""
    inside = _WORD[raw]
    turn = np.diff(inside.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    # texts next to each other with no separator between them
    glued = borders[:-1][(borders[:-1] > 0) & (borders[:-1] < len(raw))]
    glued = glued[inside[glued - 1] & inside[glued]]
    glued = glued[np.diff(glued, prepend=-1) > 0]
    starts = np.sort(np.concatenate([np.flatnonzero(turn == 1), glued]))
    ends = np.sort(np.concatenate([np.flatnonzero(turn == -1), glued]))
    del turn
    if not len(starts):
        return
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    letters = _FOLD[raw[inside]]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    encoded = words.dictionary_encode()
    order = pc.sort_indices(encoded.dictionary).to_numpy()
    vocabulary = encoded.dictionary.take(pa.array(order))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    word = rank[encoded.indices.to_numpy()]
    del words, encoded, letters, inside
    text = np.searchsorted(borders, starts, side="right")
    piece = np.searchsorted(np.flatnonzero(_PIECE_END[raw]), starts)
    lang_names = langs.unique().sort()
    lang = pc.index_in(langs, lang_names).to_numpy()[text].astype(np.int64)
    # the piece has to be the same; texts differ even where no separator lies between them
    same = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
    del text, piece
    size = len(vocabulary)
    ids = lang * size + word
    at = np.arange(len(word))
    components: list[np.ndarray] = []
    for n in range(1, longest + 1):
        if n > 1:
            fits = (at + n - 1 < len(word)) & np.append(same, False)[np.minimum(at + n - 2, len(word) - 1)]
            at, index = at[fits], index[fits]
            ids = index * size + word[at + n - 1]
        if not len(ids):
            return
        values, index, counts = np.unique(ids, return_inverse=True, return_counts=True)
        head, tail = np.divmod(values, size)
        components = [head, tail] if n == 1 else [*(c[head] for c in components), tail]
        keys = [lang_names.take(pa.array(components[0])), *(vocabulary.take(pa.array(c)) for c in components[1:])]
        yield _joined(keys), counts


class _Blocks:
    """Packs and unpacks blocks; one per task, as compressors are costly to make."""

    def __init__(self) -> None:
        self.zip = zstandard.ZstdCompressor(level=5).compress
        self.unzip = zstandard.ZstdDecompressor().decompress

    def pack(self, keys: pa.Array, counts: np.ndarray) -> tuple[bytes, bytes, bytes]:
        offsets = np.frombuffer(keys.buffers()[1], np.int64)[keys.offset : keys.offset + len(keys) + 1]
        data = keys.buffers()[2][int(offsets[0]) : int(offsets[-1])]
        return self.zip(np.diff(offsets).astype(np.uint32).tobytes()), self.zip(data), self.zip(counts.astype(np.int64).tobytes())

    def unpack(self, lengths: bytes, keys: bytes, counts: bytes) -> tuple[pa.Array, np.ndarray]:
        sizes = np.frombuffer(self.unzip(lengths), np.uint32)
        offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(self.unzip(keys))]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), buffers), np.frombuffer(self.unzip(counts), np.int64)


def _batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_RUN = pa.schema([("n", pa.int32()), *((c, pa.binary()) for c in ("first", "last", "lengths", "keys", "counts"))])
_CUT = pa.schema([("range", pa.int32()), *((c, pa.binary()) for c in ("lengths", "keys", "counts"))])


def runs(docs: DataFrame, text: str, lang: str, how: Collocations) -> DataFrame:
    """Blocks of the sorted runs of all texts."""
    name = F.hex(F.coalesce(F.col(lang).cast("string"), F.lit("und")).cast("binary"))
    rows = docs.select(name.alias("lang"), F.col(text).cast("string").alias("text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks()

        def block(keys: pa.Array, counts: np.ndarray) -> tuple:
            return len(keys), keys[0].as_py(), keys[-1].as_py(), *blocks.pack(keys, counts)

        for batch in batches:
            langs = batch.column(0).cast(pa.large_binary())
            raw, offsets = text_buffers(batch.column(1))
            cuts = _cuts(raw, offsets, how.run_bytes)
            for start, stop in zip(cuts, cuts[1:]):
                first = int(np.searchsorted(offsets, start, side="right")) - 1
                last = int(np.searchsorted(offsets, stop, side="left"))
                borders = np.minimum(offsets[first + 1 : last + 1], stop) - start
                for keys, counts in _ngrams(raw[start:stop], borders, langs[first:last], how.longest):
                    places = range(0, len(keys), how.block)
                    yield _batch_of([block(keys[p : p + how.block], counts[p : p + how.block]) for p in places], _RUN)
                    del keys, counts
                pa.default_memory_pool().release_unused()

    return rows.mapInArrow(split, RUN)


# --- ranges --------------------------------------------------------------------------------------


def _splitters(blocks: DataFrame, how: Collocations) -> list[bytes]:
    """Keys that split all n-grams into ranges of about ``per_range``."""
    totals = blocks.agg(F.count("*").alias("blocks"), F.sum("n").alias("n")).first()
    parts = math.ceil((totals.n or 0) / how.per_range)
    if parts < 2:
        return []
    share = min(1.0, how.sampled / totals.blocks)
    unit = F.shiftrightunsigned(F.xxhash64("first", "last", "keys"), 11) / float(1 << 53)
    keys = sorted(bytes(r["first"]) for r in blocks.where(unit < share).select("first").collect())
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []


def _cut(blocks: DataFrame, splitters: list[bytes]) -> DataFrame:
    """Blocks cut at the splitters; what falls into one range of the blocks at hand goes as one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Blocks()
        # few blocks at a time: a batch may hold all of a file
        for part in (batch.slice(i, _AT_ONCE) for batch in batches for i in range(0, batch.num_rows, _AT_ONCE)):
            pieces: dict[int, list] = {}
            for row in part.to_pylist():
                low, high = (bisect.bisect_right(splitters, row[c]) for c in ("first", "last"))
                keys, counts = packer.unpack(row["lengths"], row["keys"], row["counts"])
                inner = [bisect.bisect_left(range(len(keys)), s, key=lambda i: keys[i].as_py()) for s in splitters[low:high]]
                places = [0, *inner, len(keys)]
                for i, (a, b) in enumerate(zip(places, places[1:])):
                    if a < b:
                        pieces.setdefault(low + i, []).append((keys[a:b], counts[a:b]))
            out = []
            for number, found in pieces.items():
                packed = packer.pack(pa.concat_arrays([k for k, _ in found]), np.concatenate([c for _, c in found]))
                out.append((number, *packed))
            if out:
                yield _batch_of(out, _CUT)
            del pieces, out
            pa.default_memory_pool().release_unused()

    return blocks.select("first", "last", "lengths", "keys", "counts").mapInArrow(cut, "range int, lengths binary, keys binary, counts binary")


def merged(table: pa.Table) -> tuple[pa.Array, np.ndarray]:
    """One sorted stream of distinct keys from blocks, counts added."""
    unpack = _Blocks().unpack
    streams = [unpack(*(table.column(c)[i].as_py() for c in ("lengths", "keys", "counts"))) for i in range(table.num_rows)]
    keys = pa.concat_arrays([k for k, _ in streams])
    counts = np.concatenate([c for _, c in streams])
    del streams
    order = pc.sort_indices(keys)
    keys, counts = keys.take(order), counts[order.to_numpy()]
    new = np.append(True, pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False))
    starts = np.flatnonzero(new)
    return keys.take(pa.array(starts)), np.add.reduceat(counts, starts)


COUNTED = "lang string, words array<string>, f long"


def counted(blocks: DataFrame, how: Collocations) -> DataFrame:
    """``lang, words, f`` of the n-grams with the least count, and per range and language a row without words: the
    occurrences of all its words."""

    def add_up(table: pa.Table) -> pa.Table:
        keys, counts = merged(table)
        single = pc.equal(pc.count_substring(keys, _JOIN), 1).to_numpy(zero_copy_only=False)
        totals: dict[bytes, int] = {}
        for key, count in zip(keys.filter(pa.array(single)).to_pylist(), counts[single].tolist()):
            name = key.split(_JOIN, 1)[0]
            totals[name] = totals.get(name, 0) + count
        often = counts >= how.least
        out = [(name, None, f) for name, f in totals.items()]
        for key, f in zip(keys.filter(pa.array(often)).to_pylist(), counts[often].tolist()):
            name, *words = key.split(_JOIN)
            out.append((name, [w.translate(_UNFOLD).decode() for w in words], f))
        del keys, counts
        pa.default_memory_pool().release_unused()
        columns = list(zip(*out)) or [(), (), ()]
        langs = pa.array([bytes.fromhex(x.decode()).decode() for x in columns[0]], pa.string())
        return pa.table({"lang": langs, "words": pa.array(columns[1], pa.list_(pa.string())), "f": pa.array(columns[2], pa.int64())})

    return _cut(blocks, _splitters(blocks, how)).groupBy("range").applyInArrow(add_up, COUNTED)


# --- lockstep ------------------------------------------------------------------------------------


def _in_order(grams: DataFrame, turned: bool, how: Collocations) -> DataFrame:
    """N-grams with their range in prefix (or suffix) order; an n-gram that can be extended is in every range of its extensions."""
    words = F.reverse("words") if turned else F.col("words")
    # digits sort behind the tabulator, so sequences of words sort word by word
    columns = [F.hex(F.coalesce(F.get(words, F.lit(i)), F.lit("")).cast("binary")) for i in range(how.longest)]
    keyed = grams.withColumn("order_key", F.concat_ws("\t", F.hex(F.col("lang").cast("binary")), *columns))
    size = grams.count()
    parts = math.ceil(size / how.per_range * 4)
    splitters: list[str] = []
    if parts > 1:
        share = F.lit(min(1.0, parts * 50 / size))
        unit = F.shiftrightunsigned(F.xxhash64("order_key"), 11) / float(1 << 53)
        drawn = sorted(r.order_key for r in keyed.where(unit < share).select("order_key").collect())
        splitters = sorted({drawn[len(drawn) * i // parts] for i in range(1, parts)}) if drawn else []

    @F.pandas_udf("array<int>")
    def reach(keys: pd.Series) -> pd.Series:
        def one(key: str) -> list[int]:
            low = high = bisect.bisect_right(splitters, key)
            if key.endswith("\t"):
                # words are missing at the end: up to the last that can be there
                high = max(low, bisect.bisect_left(splitters, key.rstrip("\t") + "\t~"))
            return list(range(low, high + 1))

        return keys.map(one)

    return keyed.withColumn("range", F.explode(reach("order_key")))


def _passed(grams: DataFrame, turned: bool, how: Collocations) -> DataFrame:
    """Per phrase the counts of its first parts, by their length (of its last parts, if ``turned``), and the largest count of
    its extensions by one word."""
    in_range = Window.partitionBy("range").orderBy("order_key").rowsBetween(Window.unboundedPreceding, 0)
    ordered = _in_order(grams, turned, how).withColumn("size", F.size("words"))
    words = F.reverse("words") if turned else F.col("words")
    passed = [F.last(F.when(F.col("size") == n, F.col("f")), ignorenulls=True).over(in_range) for n in range(1, how.longest)]
    extended = F.lit(None).cast("long")
    for n in range(2, how.longest):
        same = Window.partitionBy("range", "lang", *(F.get(words, F.lit(i)) for i in range(n)))
        extended = F.when(F.col("size") == n, F.max(F.when(F.col("size") > n, F.col("f"))).over(same)).otherwise(extended)
    out = ordered.withColumns({"passed": F.array(*passed), "extended": extended}).where(F.col("size") > 1)
    return out.select("lang", "words", "f", F.slice("passed", F.lit(1), F.col("size") - 1).alias("parts"), "extended")


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", how: Collocations | None = None) -> DataFrame:
    """``lang, words, a, l, r, n, score, extended`` of every phrase with the least count; ``extended`` is the count of its most
    frequent extension by one word that is a phrase, too."""
    how = how or Collocations()
    counts = stage(counted(stage(runs(docs, text, lang, how), "runs"), how), "counted")
    totals = counts.where(F.col("words").isNull()).groupBy("lang").agg(F.sum("f").alias("n"))
    grams = counts.where(F.col("words").isNotNull())
    nothing = F.lit(None).cast("array<bigint>")
    left = _passed(grams, False, how).withColumnsRenamed({"parts": "lefts"}).withColumn("rights", nothing)
    right = _passed(grams, True, how).withColumnsRenamed({"parts": "rights"}).withColumn("lefts", nothing)
    both = left.unionByName(right).groupBy("lang", "words").agg(
        F.max("f").alias("a"), F.max("lefts").alias("lefts"), F.max("rights").alias("rights"), F.max("extended").alias("extended")
    )

    def cut(k: Column) -> Column:
        l, r = F.get("lefts", k - 1), F.get("rights", F.size("words") - k - 1)
        a = F.col("a").cast("decimal(19,0)")
        score = F.call_function("div", a * a * F.lit(how.scale).cast("decimal(19,0)"), l.cast("decimal(19,0)") * r.cast("decimal(19,0)"))
        return F.struct(score.alias("score"), k.alias("k"), l.alias("l"), r.alias("r"))

    lowest = F.array_min(F.transform(F.sequence(F.lit(1), F.size("words") - 1), cut))
    scored = both.withColumn("cut", lowest).join(totals, "lang")
    return scored.select("lang", "words", "a", "cut.l", "cut.r", "n", "cut.score", "extended")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", how: Collocations | None = None) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of every language that no longer one stands for."""
    how = how or Collocations()
    found = phrases(docs, text, lang, how)
    free = found.where(F.coalesce(100 * F.col("extended") < how.inside_percent * F.col("a"), F.lit(True)))
    rows = free.withColumn("phrase", F.array_join("words", " "))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may hold most phrases: first the best of each of many shares
    share = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))
    rows = rows.withColumn("share", share).withColumn("rank", some).where(F.col("rank") <= how.top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= how.top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
