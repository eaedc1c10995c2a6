"""Vectorised views of the texts in an Arrow batch: bytes, words, hashes of words and of runs of words.

A batch is taken apart into chunks of a quarter of a megabyte, each holding whole texts, so that the working memory of a task
follows the longest text and not the number of rows in a batch. Hashes are 64 bits wide and equal on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values: each bit of the input reaches every bit of the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLES: list[np.ndarray] = []


def tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n of each at least; kept by a worker for the longest text so far."""
    if not _TABLES or len(_TABLES[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _TABLES[:] = _powers(int(BASE), size), _powers(pow(int(BASE), -1, 1 << 64), size)
    return _TABLES[0], _TABLES[1]


def sums(values: np.ndarray) -> np.ndarray:
    """Running sums of values weighted by powers of the base; `span_hash` reads hashes of runs from them."""
    up, _ = tables(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def span_hash(total: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of the values [first, last) of each run; equal runs have equal hashes wherever they stand."""
    _, down = tables(len(total))
    return mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64) * BASE)


def strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One array of the column with nulls as empty strings."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column, "")


@dataclass
class Texts:
    """Bytes of some consecutive texts of a batch; text i is `data[bounds[i]:bounds[i + 1]]`."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def lowered(self) -> Texts:
        return Texts(self.first, LOWER[self.data], self.bounds)

    @cached_property
    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every word; words do not cross texts."""
        word = ~SPACE[self.data]
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.bounds] = True
        before = np.concatenate(([False], word[:-1])) & ~edge[:-1]
        after = np.concatenate((word[1:], [False])) & ~edge[1:]
        return np.flatnonzero(word & ~before[: len(word)]), np.flatnonzero(word & ~after[: len(word)]) + 1

    @cached_property
    def word_bounds(self) -> np.ndarray:
        """Words of text i are `word_bounds[i]:word_bounds[i + 1]`."""
        return np.searchsorted(self.spans[0], self.bounds)

    @cached_property
    def byte_sums(self) -> np.ndarray:
        return sums(BYTE_VALUES[self.data])

    @cached_property
    def words(self) -> np.ndarray:
        """Hash of every word."""
        return span_hash(self.byte_sums, *self.spans)


def texts(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The texts of a column in chunks of about `limit` bytes; a longer text is a chunk of its own."""
    column = strings(column)
    if not len(column):
        return
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield Texts(i, data[at[i] : at[j]], at[i : j + 1] - at[i])
        i = j


def runs(values: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First position and hash of every run of n values inside one text."""
    if len(values) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = np.zeros(len(values) + 1, np.int32)
    ends = np.maximum(bounds[1:] - n + 1, bounds[:-1])
    np.add.at(inside, bounds[:-1], 1)
    np.add.at(inside, ends, -1)
    first = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    return first, span_hash(sums(values), first, first + n)


def text_of(positions: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of the text that holds each position."""
    return np.searchsorted(bounds, positions, "right") - 1


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def covered(first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in a span [first, last)."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, first, 1)
    np.add.at(depth, last, -1)
    return np.cumsum(depth[:-1]) > 0


def sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    """Least value of every n neighbours, by doubling."""
    out, width = values, 1
    while width < n:
        step = min(width, n - width)
        out = np.minimum(out[:-step], out[step:])
        width += step
    return out


def minimizers(hashes: np.ndarray, n: int) -> np.ndarray:
    """Which of the hashes are the least of some n neighbours (all of equal ones; of fewer than n, the least)."""
    if not len(hashes):
        return np.zeros(0, bool)
    n = min(n, len(hashes))
    least = sliding_min(hashes, n)
    pad = np.zeros(n - 1, np.uint64)
    best = ~sliding_min(~np.concatenate((pad, least, pad)), n)
    return best == hashes
