"""Texts as arrays of bytes: word boundaries and hashes of byte ranges, for tasks that work on Arrow batches.

UTF-8 keeps every code point above 0x7F in bytes above 0x7F, so the words of ``[0-9a-z and all above 0x7F]`` can be
found byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text worked on at once, so that a task's arrays stay small; one longer text is worked on alone
PIECE_BYTES = 1 << 20

_BYTES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
IS_WORD = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if self.up.size < size:
            grown = 1 << (size - 1).bit_length()
            for name, base in (("up", self.base), ("down", self.inverse)):
                factors = np.full(grown, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors))
        return self.up, self.down


class RangeHash:
    """Hashes of any byte range of one array, from prefix sums of a polynomial with random coefficients per byte."""

    _powers: dict[int, Powers] = {}

    def __init__(self, data: np.ndarray, seed: int = 0):
        base = 0x9E3779B97F4A7C15 if seed == 0 else 0xD1342543DE82EF95
        powers = self._powers.setdefault(base, Powers(base))
        up, self._down = powers.of(data.size + 1)
        table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F + 2 * seed))
        self._sums = np.zeros(data.size + 1, np.uint64)
        np.cumsum(table[data] * up[: data.size], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self._sums[end] - self._sums[start]) * self._down[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))

    def of_size(self, size: int) -> np.ndarray:
        """Hashes of all ranges of ``size`` bytes, fit for comparing: their low bits are not spread."""
        raw = self._sums[size:] - self._sums[:-size]
        raw *= self._down[: raw.size]
        return raw


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Split a string column into runs of rows: first row, last row (exclusive), bytes, and row offsets into the bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    column = column.fill_null("") if column.null_count else column
    rows = len(column)
    if rows == 0:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + rows + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(rows, max(first + 1, last))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


class Words:
    """The words of a run of texts: byte ranges in the lower-cased bytes, and the row of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.rows = offsets.size - 1
        self.data = LOWER[data]
        size = data.size
        inside = np.zeros(size + 2, bool)
        inside[1 : size + 1] = IS_WORD[self.data]
        cut = np.zeros(size + 1, bool)
        cut[offsets] = True
        here = inside[1 : size + 1]
        self.start = np.flatnonzero(here & (~inside[:size] | cut[:size]))
        self.end = np.flatnonzero(here & (~inside[2:] | cut[1:])) + 1
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        self.count = np.bincount(self.row, minlength=self.rows)
        self.first = np.concatenate([[0], np.cumsum(self.count)])

    def hashes(self) -> np.ndarray:
        return RangeHash(self.data).of(self.start, self.end)

    def text(self, first: int, last: int) -> str:
        """Words first to last (exclusive), joined by single spaces."""
        data = self.data
        return b" ".join(data[s:e].tobytes() for s, e in zip(self.start[first:last], self.end[first:last])).decode()


def shingles(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (index of the first word) and hashes of all runs of ``size`` words inside one row."""
    total = hashes.size - size + 1
    if total <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    value = np.full(total, np.uint64(size), np.uint64)
    for step in range(size):
        value = value * np.uint64(0x9FB21C651E98DF25) + hashes[step : step + total]
    place = np.flatnonzero(words.row[:total] == words.row[size - 1 :])
    return place, mix(value[place])


def whole_shingles(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows with at least one word but fewer than ``size``: the place and hash of all their words as one shingle."""
    places, values = [], []
    for row in np.flatnonzero((words.count > 0) & (words.count < size)):
        length = int(words.count[row])
        value = np.full(1, np.uint64(length), np.uint64)
        for step in range(length):
            value = value * np.uint64(0x9FB21C651E98DF25) + hashes[words.first[row] + step]
        places.append(words.first[row])
        values.append(mix(value)[0])
    return np.array(places, np.int64), np.array(values, np.uint64)
