"""Words of a batch of texts as NumPy arrays: places, owners and 64-bit hashes.

A word is a run of bytes other than space and 0x09-0x0D. All work is on the UTF-8
bytes that Arrow already holds, so there is no Python object per word. Batches
are cut into chunks of about CHUNK bytes at text boundaries; a longer text is a
chunk of its own, so memory follows the longest text and not the batch. Hashes
are computed PIECE values at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
#: Values that are hashed at a time; bounds the tables of powers and the sums beside them.
PIECE = 1 << 16
_SEED = 20240607
_U = np.uint64

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BYTE_VALUES = np.random.default_rng(_SEED).integers(0, 2**64, 256, dtype=np.uint64)
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * PIECE)
            for name, step in (("up", self.base), ("down", self.inverse)):
                row = np.full(size, step, dtype=np.uint64)
                row[0] = 1
                setattr(self, name, np.multiply.accumulate(row))
        return self.up[:n], self.down[:n]

    def spans(self, values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Polynomial hash of values[start:end] for each span, not yet mixed; start in order.

        The hash of a span is the same wherever it stands, so pieces need not know one another.
        """
        out = np.zeros(len(start), dtype=np.uint64)
        i = 0
        while i < len(start):
            j = max(int(np.searchsorted(start, start[i] + PIECE)), i + 1)
            lo, hi = int(start[i]), int(end[i:j].max())
            up, down = self.upto(hi - lo + 1)
            sums = np.zeros(hi - lo + 1, dtype=np.uint64)
            np.cumsum(values[lo:hi] * up[:-1], out=sums[1:])
            s, e = start[i:j] - lo, end[i:j] - lo
            out[i:j] = (sums[e] - sums[s]) * down[s]
            i = j
        return out


BYTES = Powers(0x9E3779B97F4A7C15 | 5)
WORDS = Powers(0xC2B2AE3D27D4EB4F | 5)
OTHERS = Powers(0xD6E8FEB86659FD93 | 3)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over all bits (a bijection)."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


@dataclass
class Words:
    """Words of a chunk, in order. first[d]:first[d+1] are those of text d."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    owner: np.ndarray
    first: np.ndarray

    def hashes(self, folded: bool = False) -> np.ndarray:
        data = FOLD[self.data] if folded else self.data
        return span_hashes(data, self.start, self.end)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end] for spans in order, some PIECE bytes at a time."""
    out = np.zeros(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        j = max(int(np.searchsorted(start, start[i] + PIECE)), i + 1)
        lo, s, e = start[i], start[i:j], end[i:j]
        h = BYTES.spans(BYTE_VALUES[data[lo : e[-1]]], s - lo, e - lo)
        out[i:j] = mix(h ^ ((e - s).astype(np.uint64) * _U(0xA0761D6478BD642F)))
        i = j
    return out


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets of a string column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held else np.zeros(0, dtype=np.uint8)
    return data, offsets


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row past the last, bytes, offsets from 0) of each chunk."""
    data, offsets = utf8(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def blocks(batches: Iterable[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The rows of batches, in batches of at most size bytes of that column, however they came in.

    A longer text comes alone.
    """
    held: list[pa.RecordBatch] = []
    length = 0
    for batch in batches:
        edges = utf8(batch.column(batch.schema.get_field_index(column)))[1]
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = int(np.searchsorted(edges, edges[lo] + size - length, side="right")) - 1
            hi = min(max(hi, lo if held else lo + 1), n)
            if hi > lo:
                held.append(batch.slice(lo, hi - lo))
                length += int(edges[hi] - edges[lo])
            if hi < n:
                yield pa.concat_batches(held)
                held, length = [], 0
            lo = hi
    if held:
        yield pa.concat_batches(held)


def words_of(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> Words:
    """The words of a chunk; between flags the bytes that part them."""
    inside = ~between[data]
    begins, ends = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        full = offsets[:-1] < offsets[1:]
        heads, tails = offsets[:-1][full], offsets[1:][full] - 1
        begins[heads] = inside[heads]
        ends[tails] = inside[tails]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, offsets, start, end, owner, first)


def windows(words: Words, values: np.ndarray, length: int, powers: Powers = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of each run of length words inside one text."""
    n = len(values)
    at = np.arange(max(n - length + 1, 0))
    at = at[words.owner[at] == words.owner[at + length - 1]] if len(at) else at
    return at, mix(powers.spans(values, at, at + length))


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))
