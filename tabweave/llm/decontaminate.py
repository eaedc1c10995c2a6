"""Benchmark decontamination by the q-gram lemma.

A passage of m characters within k edits of an item shares at least m - q + 1 - k q of its q-grams, on diagonals (place in
the text less place in the item) that differ by k at most. For every text, shared q-grams are counted in overlapping bands
of diagonals; only bands that reach the bound are verified, by a banded alignment of the whole item against that stretch
of the text. Letters are compared in lower case (A-Z), runs of white space count as one space.

Items are the small side: they are sent to the tasks in parts of at most `PART_BYTES`, one reading of the documents for
each part, so their number has no bound. Nothing of the documents is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.llm.arrays import BASE, LOWER, SPACE, Texts, text_of, texts

PART_BYTES = 8 << 20
BITS = 22


@dataclass(frozen=True)
class Edits:
    """An item matches within `percent` of its characters (bytes) of edits, fewer where the bound would be void."""

    percent: int = 10
    q: int = 7
    least: int = 32

    def __post_init__(self) -> None:
        if not 1 <= self.q <= 8:
            raise ValueError("q must be from 1 to 8")

    def budget(self, m: np.ndarray) -> np.ndarray:
        return np.maximum(0, np.minimum(m * self.percent // 100, (m - self.q) // self.q))


FOLD = np.where(SPACE, np.uint8(32), LOWER)


def folded(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts in lower case with single spaces, and where each ends."""
    data = FOLD[t.data]
    space = data == 32
    again = space[1:] & space[:-1]
    inner = t.bounds[1:-1]
    again[inner[(inner > 0) & (inner < len(data))] - 1] = False
    if not again.any():
        return data, t.bounds
    keep = np.concatenate(([True], ~again))
    return data[keep], np.concatenate(([0], np.cumsum(keep)))[t.bounds]


def grams(data: np.ndarray, q: int) -> np.ndarray:
    """The q bytes (8 at most) from every place on as one number."""
    n = len(data) - q + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    wide, width = data.astype(np.uint64), 1
    out, at = np.zeros(n, np.uint64), 0
    while True:
        if q & width:
            out |= wide[at : at + n] << np.uint64(8 * at)
            at += width
        if at == q:
            return out
        wide = wide[:-width] | wide[width:] << np.uint64(8 * width)
        width *= 2


def slot(gram: np.ndarray) -> np.ndarray:
    return (gram * BASE) >> np.uint64(64 - BITS)


class Items:
    """q-grams of some items: a bitmap and a sorted table of them, and their places in items."""

    def __init__(self, ids: list[int], items: list[bytes], edits: Edits):
        self.edits = edits
        (whole,) = texts(pa.array(items, pa.large_binary()).cast(pa.large_string()), 1 << 62) if items else (Texts(0, np.zeros(0, np.uint8), np.zeros(1, np.int64)),)
        data, bounds = folded(whole)
        # Outer spaces are no part of an item.
        first, last = bounds[:-1].copy(), bounds[1:].copy()
        for i in range(len(first)):
            first[i] += first[i] < last[i] and data[first[i]] == 32
            last[i] -= first[i] < last[i] and data[last[i] - 1] == 32
        keep = np.flatnonzero(last - first >= edits.least)
        self.ids = np.array(ids, np.int64)[keep]
        cells = [data[a:b] for a, b in zip(first[keep], last[keep])]
        self.data = np.concatenate(cells) if cells else np.zeros(0, np.uint8)
        self.bounds = np.concatenate(([0], np.cumsum([len(c) for c in cells]))).astype(np.int64)
        self.sizes = np.diff(self.bounds)
        self.budget = edits.budget(self.sizes)
        self.bound = self.sizes - edits.q + 1 - self.budget * edits.q
        gram = grams(self.data, edits.q)
        at = self._inside(np.arange(len(gram)), self.bounds)
        gram = gram[at]
        by = np.argsort(gram, kind="stable")
        self.item = text_of(at, self.bounds)[by]
        self.place = (at - self.bounds[text_of(at, self.bounds)])[by]
        self.grams, self.start = np.unique(gram[by], return_index=True)
        self.stop = np.append(self.start[1:], len(by))
        self.bits = np.zeros(1 << BITS, bool)
        self.bits[slot(self.grams)] = True

    def _inside(self, at: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The places whose q-gram does not reach into the next text."""
        return at[at + self.edits.q <= bounds[text_of(at, bounds) + 1]] if len(at) else at

    def hits(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, item, diagonal (from the start of the text) and place in the item of every shared q-gram."""
        gram = grams(data, self.edits.q)
        at = self._inside(np.flatnonzero(self.bits[slot(gram)]), bounds)
        gram = gram[at]
        index = np.minimum(np.searchsorted(self.grams, gram), max(0, len(self.grams) - 1))
        same = self.grams[index] == gram if len(self.grams) else np.zeros(0, bool)
        at, index = at[same], index[same]
        count = self.stop[index] - self.start[index]
        entry = np.repeat(self.start[index] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum()) if len(index) else np.zeros(0, np.int64)
        text = np.repeat(text_of(at, bounds), count)
        return text, self.item[entry], np.repeat(at, count) - bounds[text] - self.place[entry], self.place[entry]

    def regions(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, item and first diagonal of the bands that reach the bound."""
        text, item, diagonal, place = self.hits(data, bounds)
        if not len(text):
            return text, item, diagonal
        n = len(self.ids)
        # A text must share enough with an item at all before its hits are counted by band.
        pair = text * n + item
        names, which = np.unique(pair, return_inverse=True) if (text[-1] + 1) * n > 8 * len(pair) else (None, pair)
        total = np.bincount(which)
        some = np.flatnonzero(total[which] >= self.bound[item])
        pair, item, diagonal, place = pair[some], item[some], diagonal[some], place[some]
        if not len(some):
            return pair, item, diagonal
        # Cells of budget + 1 diagonals; a band is two cells in a row, so the diagonals of a passage lie in one band.
        # Each q-gram of the item counts once in a cell.
        cell = diagonal // (self.budget[item] + 1)
        low, high = int(cell.min()), int(cell.max()) + 2
        longest = int(self.sizes.max())
        key = np.sort((pair * (high - low) + (cell - low)) * longest + place)
        key = key[np.concatenate(([True], key[1:] != key[:-1]))] // longest
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        count = np.diff(np.append(start, len(key)))
        key = key[start]
        follows = np.concatenate((key[1:] == key[:-1] + 1, [False]))
        band = count + np.where(follows, np.append(count[1:], 0), 0)
        pair, cell = key // (high - low), key % (high - low) + low
        item = pair % n
        good = np.flatnonzero(band >= self.bound[item])
        return pair[good] // n, item[good], cell[good] * (self.budget[item[good]] + 1)

    def _literal(self, data: np.ndarray, bounds: np.ndarray, text: int, item: int, diagonal: int) -> int:
        """0 if the item itself stands in the band, 1 if an alignment must tell."""
        k, size = int(self.budget[item]), int(self.sizes[item])
        first = max(int(bounds[text]), int(bounds[text]) + diagonal - k)
        last = min(int(bounds[text + 1]), int(bounds[text]) + diagonal + 3 * k + 3 + size)
        return int(self.data[self.bounds[item] : self.bounds[item] + size].tobytes() not in data[first:last].tobytes())

    def aligned(self, data: np.ndarray, bounds: np.ndarray, text: np.ndarray, item: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """Least edits between each item and a passage of its text whose path stays near the band."""
        k = self.budget[item]
        out = np.full(len(text), 1 << 30, np.int64)
        if not len(text):
            return out
        width = int((4 * k + 3).max())
        offset = np.arange(width)
        start, stop = bounds[text], bounds[text + 1]
        near = start + diagonal - k
        row = np.zeros((len(text), width), np.int32)
        outside = 1 << 20
        for i in range(int(self.sizes[item].max())):
            live = i < self.sizes[item]
            letter = self.data[self.bounds[item] + np.minimum(i, self.sizes[item] - 1)]
            at = near[:, None] + i + offset
            inside = (at >= start[:, None]) & (at < stop[:, None])
            differs = np.where(inside, data[np.clip(at, 0, max(0, len(data) - 1))] != letter[:, None], True)
            step = row + np.where(inside, differs, outside).astype(np.int32)
            # Offset o of row i + 1 is the place `near + i + 1 + o - 1`; leaving out a letter of the item keeps the place.
            skip = np.concatenate((row[:, 1:], np.full((len(text), 1), outside, np.int32)), axis=1) + 1
            skip_place = np.concatenate((at[:, 1:], at[:, -1:] + 1), axis=1) - 1
            skip = np.where((skip_place >= start[:, None] - 1) & (skip_place < stop[:, None]), skip, outside)
            new = np.minimum(step, skip)
            new = np.minimum.accumulate(new - offset, axis=1) + offset
            row = np.where(live[:, None], np.minimum(new, outside), row)
            done = i + 1 == self.sizes[item]
            out[done] = row[done].min(axis=1)
        return out

    def found(self, t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, item id and least edits of every item found in the texts of a chunk."""
        data, bounds = folded(t)
        text, item, diagonal = self.regions(data, bounds)
        edits = np.array([self._literal(data, bounds, *c) for c in zip(text.tolist(), item.tolist(), diagonal.tolist())], np.int64)
        left = np.flatnonzero(edits)
        edits[left] = self.aligned(data, bounds, text[left], item[left], diagonal[left])
        good = edits <= self.budget[item] if len(text) else np.zeros(0, bool)
        text, item, edits = text[good], item[good], edits[good]
        by = np.lexsort((edits, item, text))
        new = np.concatenate(([True], (np.diff(text[by]) != 0) | (np.diff(item[by]) != 0)))[: len(by)]
        by = by[new]
        return text[by], self.ids[item[by]], edits[by]


def parts(benchmark: DataFrame, item: str, text: str, edits: Edits) -> Iterator[Items]:
    """The items in parts of a bounded size; at least one part, which may be empty."""
    ids, cells, size, any_part = [], [], 0, False
    rows = benchmark.select(benchmark[item].cast("bigint").alias("i"), benchmark[text].cast("string").alias("t")).where("t IS NOT NULL AND i IS NOT NULL")
    for row in rows.orderBy("i", "t").toLocalIterator():
        raw = row.t.encode()
        if cells and size + len(raw) > PART_BYTES:
            yield Items(ids, cells, edits)
            ids, cells, size, any_part = [], [], 0, True
        ids.append(row.i)
        cells.append(raw)
        size += len(raw)
    if cells or not any_part:
        yield Items(ids, cells, edits)


def leaks(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", edits: Edits = Edits()) -> DataFrame:
    """(doc, item, edits) of every item found in a document, `edits` of the best passage.

    Null and empty texts hold nothing; null ids and null texts of items name nothing, nor do items of fewer than
    `edits.least` characters. Documents are searched whatever their id. Items that occur twice in a document, and repeated
    documents or items, are one row each. Other columns are not read.
    """
    source = docs.select(docs[doc].cast("bigint").alias("doc"), docs[text].cast("string").alias("text"))
    out = None
    for part in parts(benchmark, item, item_text, edits):
        shared = docs.sparkSession.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for t in texts(batch.column(1)):
                    at, ids, n = shared.value.found(t)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at + t.first)), pa.array(ids, pa.int64()), pa.array(n, pa.int64())], names=["doc", "item", "edits"])

        found = source.mapInArrow(run, "doc long, item long, edits long")
        out = found if out is None else out.unionByName(found)
    return out.groupBy("doc", "item").agg(F.min("edits").alias("edits"))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", edits: Edits = Edits()) -> DataFrame:
    """The rows of `docs` that hold no item, with all their columns unchanged; rules as for `leaks`."""
    position, out = docs.columns.index(text), docs
    for part in parts(benchmark, item, item_text, edits):
        shared = docs.sparkSession.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for t in texts(batch.column(position)):
                    keep = np.ones(len(t), bool)
                    keep[shared.value.found(t)[0]] = False
                    yield batch.slice(t.first, len(t)).filter(pa.array(keep))

        out = out.mapInArrow(run, docs.schema)
    return out
