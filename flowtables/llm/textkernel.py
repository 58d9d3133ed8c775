"""Words of whole Arrow text columns as NumPy arrays: where they lie, what they hash to.

Tasks see a text column as one run of UTF-8 bytes. Word borders, hashes, windows and counts are then array operations
over all texts of a slice at once. Slices hold about ``SLICE_BYTES`` of text, so memory stays flat however long a
partition is; a text longer than that is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21
#: Of functions that make several 64-bit numbers of every byte: as fast, with a fraction of the memory.
SMALL_SLICE_BYTES = 1 << 19


def byte_table(members: bytes | range, inverted: bool = False) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return ~table if inverted else table


#: Bytes of words: all but space and \t \n \v \f \r.
WORD = byte_table(b" \t\n\v\f\r", inverted=True)
#: Bytes of UTF-8 that begin a code point.
CODE_POINT = byte_table(range(0x80, 0xC0), inverted=True)
#: Lower-cases A-Z and nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: A random 64-bit number for each byte.
_CODES = np.random.default_rng(20_240_601).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, nulls as empty, and its borders: text i is ``data[borders[i]:borders[i + 1]]``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, borders, data = column.buffers()
    borders = np.frombuffer(borders, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[borders[0] : borders[-1]], borders - borders[0]


def sliced(
    batches: Iterator[pa.RecordBatch], column: str, slice_bytes: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with the bytes and borders of one text column."""
    for batch in batches:
        data, borders = texts(batch.column(batch.schema.get_field_index(column)))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(borders, borders[begin] + slice_bytes, side="right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield (
                batch.slice(begin, end - begin),
                data[borders[begin] : borders[end]],
                borders[begin : end + 1] - borders[begin],
            )
            begin = end


def runs(data: np.ndarray, borders: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of member bytes within each text: starts, ends, and where each text's runs begin in these."""
    inside = members[data]
    edge = inside.copy()
    edge[1:] &= ~inside[:-1]
    breaks = borders[:-1][borders[:-1] < len(data)]
    edge[breaks] = inside[breaks]
    starts = np.flatnonzero(edge)
    edge = inside
    if len(data):
        last = edge.copy()
        last[:-1] &= ~edge[1:]
        tails = borders[1:][borders[1:] > 0] - 1
        last[tails] = edge[tails]
        ends = np.flatnonzero(last) + 1
    else:
        ends = starts
    return starts, ends, np.searchsorted(starts, borders)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Hasher:
    """64-bit hashes of ranges of a sequence, by differences of one running sum."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.up) <= n:
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                powers = np.full(n + n // 4 + 1024, base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers, dtype=np.uint64))

    def ranges(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of each ``values[start:end]``, where values are 64-bit numbers."""
        self._reach(len(values))
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=total[1:])
        out = (total[ends] - total[starts]) * self.down[starts]
        return mixed(out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def of_bytes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.ranges(_CODES[data], starts, ends)


def windows(values: np.ndarray, size: int) -> np.ndarray:
    """The hash of each ``size`` neighbouring values (hashes themselves), borders of texts not heeded."""
    n = max(0, len(values) - size + 1)
    out = np.zeros(n, np.uint64)
    step = mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    for k in range(size):
        out += values[k : k + n] * step[k]
    return mixed(out)


def owners(first: np.ndarray) -> np.ndarray:
    """The text of each word, given where each text's words begin."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def whole_windows(first: np.ndarray, size: int) -> np.ndarray:
    """The words at which a window of ``size`` words begins that lies in one text."""
    total = int(first[-1]) if len(first) else 0
    begins = np.zeros(total + 1, np.int64)
    fits = np.diff(first) >= size
    np.add.at(begins, first[:-1][fits], 1)
    np.add.at(begins, first[1:][fits] - size + 1, -1)
    return np.flatnonzero(np.cumsum(begins[:-1]) > 0)


def covered(begins: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of ``total`` words lie in a window of ``size`` words that starts at one of ``begins``."""
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, begins + size, -1)
    return np.cumsum(change[:-1]) > 0


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of each text's values."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def mapped(df, function, column: str, schema: str, slice_bytes: int = SLICE_BYTES):
    """``function(slice, data, borders)`` on slices of a table; it returns a dict of columns or None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {"hasher": Hasher()}
        for batch, data, borders in sliced(batches, column, slice_bytes):
            out = function(batch, data, borders, state)
            if out is not None:
                yield pa.RecordBatch.from_pydict(out)

    return df.mapInArrow(run, schema)
