"""Words of whole Arrow string columns as NumPy arrays: boundaries, hashes and minima.

Texts are handled as UTF-8 bytes in pieces of bounded size, so a batch of long documents never
needs more than a few arrays of one piece (a document longer than a piece is a piece of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 19

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

MASK = (1 << 64) - 1
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
BYTE_VALUE = np.random.default_rng(20).integers(1, MASK, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** n`` modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) <= n:
        factors = np.full(max(n, PIECE_BYTES) + 1, base, dtype=np.uint64)
        factors[0] = 1
        known = np.multiply.accumulate(factors)
        if len(known) <= 4 * PIECE_BYTES:
            _powers[base] = known
    return known


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sums:
    """Hashes of any range of a sequence from its prefix sums."""

    def __init__(self, values: np.ndarray, base: int):
        n = len(values)
        self.inverse = powers(pow(base, -1, 1 << 64), n)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * powers(base, n)[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


class Texts:
    """Some rows of a string column: bytes, and the words of all of them in order."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, lower: bool = False):
        self.offsets, self.rows = offsets, len(offsets) - 1
        self.data = data = LOWER[data] if lower else data
        space = SPACE[data]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        before, after = np.ones(len(data), dtype=bool), np.ones(len(data), dtype=bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        before[inner], after[inner - 1] = True, True
        self.starts = np.flatnonzero(~space & before)
        self.ends = np.flatnonzero(~space & after) + 1
        #: index of the first word of every row, and the number of all words at the end
        self.firsts = np.searchsorted(self.starts, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.firsts)

    def row_of_words(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts)

    def word_hashes(self) -> np.ndarray:
        return Sums(BYTE_VALUE[self.data], BYTE_BASE).of(self.starts, self.ends)

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words with one space after each, and where each begins and ends there."""
        lengths = self.ends - self.starts
        ends = np.cumsum(lengths + 1) - 1
        out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 32, dtype=np.uint8)
        keep = ~SPACE[self.data]
        place = np.arange(len(out))
        gaps = np.zeros(len(out), dtype=bool)
        gaps[ends] = True
        out[place[~gaps]] = self.data[keep]
        return out.tobytes(), ends - lengths, ends


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from zero) and bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column into runs of whole rows of about ``limit`` bytes: first row, end row, offsets, bytes."""
    offsets, data = column_bytes(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, offsets[first : end + 1] - offsets[first], data[offsets[first] : offsets[end]]
        first = end


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)
