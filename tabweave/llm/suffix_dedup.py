"""Suffix-array dedup on bytes by merging the Burrows-Wheeler transforms of shards.

A byte goes if some window of bytes around it also starts anywhere else. A region found twice settles all its windows.
Differing regions of an anchor (see `repeats`) are cut, from the anchor, into blocks of equal length; blocks are numbered
in the order of their bytes and are the letters of a text, one string per region. Shards of these strings are sorted each
by itself and turned into Burrows-Wheeler transforms. Two transforms are merged by refining their interleave: sorting it
stably by its letters puts it in order by one more letter each time, until it stands still. No suffix is sorted again.
The round in which two neighbours part is their common prefix in blocks; their bytes give the rest. Intervals of
neighbours with a common prefix of the window less the bytes before the block are split by those bytes; what is left with
two regions or more is a window found elsewhere.

Regions of one anchor are aligned at it, so windows at equal offsets of different regions are different places.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabweave.llm.arrays import BYTE_VALUES, covered, mix
from tabweave.llm.repeats import Grain, Regions, applied, spans

WINDOW, GRAM = 400, 300
BLOCK = 40
SHARD = 1 << 16


@dataclass
class Shard:
    """A transform: suffixes in order, the letter before each (0 at the start of a string), and how many are empty."""

    order: np.ndarray
    before: np.ndarray
    empty: int


def letters(regions: Regions) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of all regions in turn, each string closed by an empty one: start and end in the bytes, letter, owner.

    A region's first block starts at the anchor less as many blocks as fit; its last may be short. Letters are numbered
    from 1 in the order of bytes (a block before its extensions); the empty block is 0.
    """
    starts = regions.bounds[:-1] + regions.left % BLOCK
    n = -(-(regions.bounds[1:] - starts) // BLOCK) + 1
    owner = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    end = regions.bounds[1:][owner]
    first = np.minimum(starts[owner] + place * BLOCK, end)
    last = np.minimum(first + BLOCK, end)
    padded = np.concatenate((regions.data, np.zeros(BLOCK, np.uint8)))
    cells = np.lib.stride_tricks.sliding_window_view(padded, BLOCK)[first]
    cells[np.arange(BLOCK) >= (last - first)[:, None]] = 0
    keys = cells.view(">u8").astype(np.uint64)
    del cells, padded
    columns = [last - first, *keys.T[::-1]]
    by = np.lexsort(columns)
    new = np.zeros(len(by), bool)
    for c in columns:
        new[1:] |= c[by][1:] != c[by][:-1]
    letter = np.empty(len(by), np.int64)
    letter[by] = np.cumsum(new) + (1 if len(by) and last[by[0]] > first[by[0]] else 0)
    return first, last, letter, owner


def shard(letter: np.ndarray, at: int, stop: int) -> Shard:
    """The transform of the strings in [at, stop), sorted by doubling; empty suffixes differ by their place."""
    own = letter[at:stop]
    n = len(own)
    rank = np.where(own == 0, np.cumsum(own == 0) - 1, 0)
    empty = int((own == 0).sum())
    key = np.where(own == 0, rank, own + empty)
    ends = np.flatnonzero(own == 0)
    end = ends[np.searchsorted(ends, np.arange(n))]
    order = np.argsort(key, kind="stable")
    width = 1
    while True:
        new = np.ones(n, bool)
        new[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        if new.all():
            break
        follow = rank[np.minimum(np.arange(n) + width, end)]
        key = rank * (n + 1) + follow
        order = np.argsort(key, kind="stable")
        width *= 2
    before = np.where(np.concatenate(([True], own[:-1] == 0)), 0, np.concatenate(([0], own[:-1])))
    return Shard(order + at, before[order], empty)


def merge(a: Shard, b: Shard) -> tuple[Shard, np.ndarray]:
    """The transform of both and the common prefix, in letters, of each suffix with its forerunner."""
    n = len(a.order) + len(b.order)
    from_b = np.repeat(np.array([False, True]), (len(a.order), len(b.order)))
    empty = a.empty + b.empty
    head = np.repeat(np.array([False, True]), (a.empty, b.empty))
    block = np.zeros(n, np.int64)
    common = np.full(n, -1, np.int64)
    before = np.empty(n, np.int64)
    depth = 0
    while True:
        before[~from_b], before[from_b] = a.before, b.before
        some = np.flatnonzero(before)
        by = some[np.argsort(before[some], kind="stable")]
        refined = np.concatenate((head, from_b[by]))
        new = np.ones(n, bool)
        letter, source = before[by], block[by]
        new[empty + 1 :] = (letter[1:] != letter[:-1]) | (source[1:] != source[:-1])
        common[new & (common < 0)] = depth
        depth += 1
        still = np.array_equal(refined, from_b) and new.sum() == block[-1] + 1
        from_b, block = refined, np.cumsum(new) - 1
        if still:
            break
    before[~from_b], before[from_b] = a.before, b.before
    order = np.empty(n, np.int64)
    order[~from_b], order[from_b] = a.order, b.order
    return Shard(order, before, empty), common


def sorted_suffixes(letter: np.ndarray, size: int = SHARD) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order and the common prefix of each with its forerunner, from merged shards of about `size` letters."""
    ends = np.flatnonzero(letter == 0) + 1
    n = max(2, -(-len(letter) // size))
    cuts = sorted({0, len(letter), *(int(ends[np.searchsorted(ends, len(letter) * i // n)]) for i in range(1, n))})
    shards = [shard(letter, a, b) for a, b in zip(cuts, cuts[1:])] or [shard(letter, 0, 0)]
    common = np.zeros(0, np.int64)
    if len(shards) == 1:
        shards.append(Shard(np.zeros(0, np.int64), np.zeros(0, np.int64), 0))
    while len(shards) > 1:
        merged = []
        for i in range(0, len(shards) - 1, 2):
            both, common = merge(shards[i], shards[i + 1])
            merged.append(both)
        shards = merged + shards[len(shards) // 2 * 2 :]
    return shards[0].order, common


def solve(regions: Regions) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of each region that another region of its anchor holds too."""
    none = np.zeros(0, np.int64)
    if len(regions.region) < 2:
        return none, none, none, none
    first, last, letter, owner = letters(regions)
    order, common = sorted_suffixes(letter)
    a, b = first[order[1:]], first[order[:-1]]
    # Bytes after the common blocks, up to the end of either string.
    step = common[1:] * BLOCK
    room = np.minimum(regions.bounds[1:][owner[order[1:]]] - a, regions.bounds[1:][owner[order[:-1]]] - b) - step
    length = step.copy()
    going = np.flatnonzero((room > 0) & (step + BLOCK > WINDOW - BLOCK))
    for k in range(BLOCK):
        going = going[room[going] > k]
        going = going[regions.data[a[going] + step[going] + k] == regions.data[b[going] + step[going] + k]]
        length[going] += 1
    length = np.concatenate(([0], np.minimum(length, step + np.maximum(room, 0))))
    # Hash of the bytes before each block, longer by one each turn.
    ahead = np.zeros(len(first), np.uint64)
    start = regions.bounds[:-1][owner]
    anchor_at = start + regions.left[owner]
    flags = np.zeros((len(regions.region), WINDOW - GRAM + 1), bool)
    _, group = np.unique(regions.anchor, return_inverse=True)
    for lead in range(BLOCK):
        if lead:
            ahead = mix(ahead ^ BYTE_VALUES[regions.data[np.maximum(first - lead, 0)]])
        interval = np.cumsum(length < WINDOW - lead)
        size = np.bincount(interval)
        some = order[size[interval] > 1]
        run = interval[size[interval] > 1]
        at = first[some] - lead
        offset = anchor_at[some] - at
        fits = (at >= start[some]) & (offset >= 0) & (offset <= WINDOW - GRAM) & (at + WINDOW <= regions.bounds[1:][owner[some]])
        some, run, at, offset = some[fits], run[fits], at[fits], offset[fits]
        if len(some) < 2:
            continue
        key = mix(ahead[some] ^ mix(run.astype(np.uint64) << np.uint64(8) | (offset.astype(np.uint64) & np.uint64(255))) + group[owner[some]].astype(np.uint64))
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        found = count[inverse] > 1
        flags[owner[some][found], offset[found]] = True
    edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    index, begin = np.nonzero(edge == 1)
    _, stop = np.nonzero(edge == -1)
    return index, begin, stop - 1, np.full(len(index), -1, np.int64)


GRAIN = Grain(WINDOW, GRAM, lambda t: (BYTE_VALUES[t.data], t.bounds), lambda t: t.data, False, solve)


def dedup(docs: DataFrame, doc: str = "doc_id", text: str = "text", with_kept: bool = True) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept, kept_sha256) of every row; `kept` are the remaining bytes, unless not wanted.

    Windows are judged on the input. A null text is empty. Repeated rows are different places, so their windows are all
    found twice; any id, null too, is a document like others. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                out: list[tuple] = []
                for text_, first, last in zip(*(rows.column(i) for i in (1, 2, 3))):
                    raw = (text_.as_py() or "").encode()
                    kept, n = raw, 0
                    if first.is_valid and len(first):
                        away = covered(np.array(first.as_py()), np.array(last.as_py()), len(raw))
                        kept = np.frombuffer(raw, np.uint8)[~away].tobytes()
                        n = int(away[0]) + int((away[1:] & ~away[:-1]).sum())
                    out.append((len(raw), len(raw) - len(kept), n, hashlib.sha256(kept).hexdigest(), *([kept] if with_kept else [])))
                columns = [rows.column(0), *[pa.array(c, f.type) for c, f in zip(zip(*out), fields)]]
                yield pa.RecordBatch.from_arrays(columns, names=["id", *[f.name for f in fields]])

    counts = [pa.field(c, pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")]
    fields = [*counts, pa.field("kept_sha256", pa.string()), *([pa.field("kept", pa.binary())] if with_kept else [])]
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_kept else "")
    return applied(docs, spans(docs, GRAIN, doc, text), doc, text, run, schema)
