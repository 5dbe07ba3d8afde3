"""Words, word hashes and n-gram hashes of Arrow text columns, as whole-array operations.

Everything works on the UTF-8 bytes of a batch at once, so that no Python object exists per word.
Word classes are byte tables: all bytes of a character outside ASCII are word bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

WHITE = frozenset(b" \t\n\x0b\x0c\r")
ALNUM_OR_WIDE = frozenset(range(256)) - frozenset(range(128)) | frozenset(
    b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
)

#: texts are tokenised in groups of about so many bytes; one longer text is a group of its own
GROUP_BYTES = 2 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing, so that sums and products of hashes spread over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


def _ladder(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    global _powers, _inverse
    if len(_powers) < size:
        steps = np.full(max(size, GROUP_BYTES + 1), _ODD, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
        steps[1:] = np.uint64(pow(int(_ODD), -1, 1 << 64))
        _inverse = np.multiply.accumulate(steps)
    return _powers, _inverse


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """Running polynomial hash of bytes; ``range_hash`` reads the hash of any range from it."""
    powers, _ = _ladder(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[raw] * powers[: len(raw)], out=total[1:])
    return total


def range_hash(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, inverse = _ladder(len(total))
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def gram_range_hashes(total: np.ndarray, size: int) -> np.ndarray:
    """``range_hash`` of the ``size`` bytes from each place on."""
    places = len(total) - size
    _, inverse = _ladder(len(total))
    return mix((total[size:] - total[:places]) * inverse[:places] + np.uint64(size))


@dataclass
class Words:
    """The words of some texts: ``rows`` are the texts' places in the batch, ``first`` the index of
    the first word of each text (one more entry at the end)."""

    rows: np.ndarray
    first: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    raw: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        """Index into ``rows`` of every word."""
        return np.repeat(np.arange(len(self.rows)), self.counts)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def grouped_rows(offsets: np.ndarray, size: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop


class Tokenizer:
    """Splits texts into maximal runs of word bytes, optionally with A-Z lower-cased first."""

    def __init__(self, word_bytes: frozenset, lower: bool):
        self.is_word = np.isin(np.arange(256), sorted(word_bytes))
        self.folded = np.arange(256, dtype=np.uint8)
        if lower:
            self.folded[ord("A") : ord("Z") + 1] += 32

    def groups(self, column: pa.Array) -> Iterator[Words]:
        raw, offsets = text_buffers(column)
        for start, stop in grouped_rows(offsets):
            yield self.split(raw, offsets, start, stop)

    def split(self, raw: np.ndarray, offsets: np.ndarray, start: int, stop: int) -> Words:
        base = offsets[start]
        piece = self.folded[raw[base : offsets[stop]]]
        bounds = offsets[start : stop + 1] - base
        inside = self.is_word[piece]
        # a word begins where the byte before is no word byte or belongs to another text
        before = np.zeros(len(piece), bool)
        before[1:] = inside[:-1]
        inner = bounds[:-1][bounds[:-1] < len(piece)]
        before[inner] = False
        after = np.zeros(len(piece), bool)
        after[:-1] = inside[1:]
        last = bounds[1:][bounds[1:] > 0] - 1
        after[last] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        hashes = range_hash(prefix_hash(piece), starts, ends)
        return Words(np.arange(start, stop), np.searchsorted(starts, bounds), hashes, starts, ends, piece)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on, text borders ignored; shorter by n - 1."""
    size = max(0, len(hashes) - n + 1)
    total = np.zeros(size, np.uint64)
    for k in range(n):
        total = mix(total * _ODD + hashes[k : k + size])
    return total


def gram_starts(first: np.ndarray, n: int) -> np.ndarray:
    """Marks the words from which n words lie in one text; as long as ``gram_hashes``."""
    words = int(first[-1])
    fits = np.ones(max(0, words - n + 1), bool)
    for k in range(1, n):
        border = first[1:-1] - k
        border = border[(border >= 0) & (border < len(fits))]
        fits[border] = False
    return fits


def fixed_binary(values: np.ndarray) -> pa.Array:
    """Rows of a two-dimensional array as a binary column."""
    values = np.ascontiguousarray(values)
    width = values.strides[0] if len(values) else 1
    offsets = np.arange(len(values) + 1, dtype=np.int64) * width
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(values.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(values), buffers)


def ragged_binary(values: np.ndarray, borders: np.ndarray) -> pa.Array:
    """Slices ``values[borders[i]:borders[i + 1]]`` as a binary column."""
    offsets = (borders * values.itemsize).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values).tobytes())]
    return pa.Array.from_buffers(pa.large_binary(), len(borders) - 1, buffers).cast(pa.binary())
