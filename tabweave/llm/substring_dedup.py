"""Substring dedup on words with suffix automata of reference shards.

A word goes if some window of words around it also starts in a document with a smaller id. Where a whole region around an
anchor is found in an earlier document, that settles all its windows. Differing regions of an anchor (see `repeats`) make
up reference shards, dealt by anchor so that all places of a window meet in one shard. Of each shard a suffix automaton is
built, whose states know the smallest document that holds their words. The regions stream through it; where the matching
statistic reaches the window length, the state names the earliest document of that window, and consecutive windows with
the same answer become one span.

An automaton of the whole reference would have to be sent to every task and grows with the corpus. Here each shard's
automaton stays in the task that built it, and only the regions whose anchors lie in it come by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabweave.llm.arrays import Texts, covered, text_of
from tabweave.llm.repeats import LAST, Grain, Regions, applied, spans

WINDOW, GRAM = 13, 5


class Automaton:
    """Suffix automaton of several word sequences; each state has the smallest document that holds its words."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.doc = [-1], [0], [LAST]

    def _state(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.doc.append(LAST)
        return len(self.link) - 1

    def _split(self, state: int, word: int, to: int) -> int:
        """The state for the words of `state` and `word` when `to` stands for more words."""
        copy = self._state(self.length[state] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = copy
        while state >= 0 and self.next[state].get(word) == to:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def add(self, words: list[int], doc: int) -> None:
        last = 0
        for word in words:
            to = self.next[last].get(word)
            if to is not None:
                last = to if self.length[to] == self.length[last] + 1 else self._split(last, word, to)
            else:
                new, state = self._state(self.length[last] + 1, {}, 0), last
                while state >= 0 and word not in self.next[state]:
                    self.next[state][word] = new
                    state = self.link[state]
                if state >= 0:
                    to = self.next[state][word]
                    self.link[new] = to if self.length[to] == self.length[state] + 1 else self._split(state, word, to)
                last = new
            self.doc[last] = min(self.doc[last], doc)

    def close(self) -> None:
        """Pass the smallest documents on to the states of shorter words."""
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            self.doc[up] = min(self.doc[up], self.doc[state])

    def earliest(self, words: list[int], window: int) -> list[int]:
        """Smallest document of the window that ends at each word, from the matching statistics; LAST where none does."""
        out, state, matched = [], 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            to = self.next[state].get(word)
            state, matched = (to, matched + 1) if to is not None else (0, 0)
            while self.length[self.link[state]] >= window:
                state = self.link[state]
                matched = self.length[state]
            out.append(self.doc[state] if matched >= window else LAST)
        return out


def pieces(regions: Regions, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of a window or more whose words are all found twice or more in the shard, as content, start and end.

    Other words are in no window found elsewhere. Also returned: the words as small numbers.
    """
    _, word, count = np.unique(regions.data, return_inverse=True, return_counts=True)
    inside = (count > 1)[word]
    edge = np.zeros(len(word) + 1, bool)
    edge[regions.bounds] = True
    first = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
    last = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    long = last - first >= window
    return word, first[long], last[long]


def solve(regions: Regions) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of each region that an earlier document than the region's own first one holds."""
    empty = np.zeros(0, np.int64)
    if not len(regions.region):
        return empty, empty, empty, empty
    word, first, last = pieces(regions, WINDOW)
    index = text_of(first, regions.bounds)
    earliest_of: dict[bytes, int] = {}
    names = [word[a:b].tobytes() for a, b in zip(first, last)]
    for name, doc in zip(names, regions.doc[index].tolist()):
        earliest_of[name] = min(doc, earliest_of.get(name, LAST))
    automaton, found = Automaton(), {}
    for name, doc in earliest_of.items():
        automaton.add(np.frombuffer(name, word.dtype).tolist(), doc)
    automaton.close()
    for name in earliest_of:
        found[name] = np.array(automaton.earliest(np.frombuffer(name, word.dtype).tolist(), WINDOW)[WINDOW - 1 :], np.int64)
    rows: list[tuple[int, int, int, int]] = []
    for i, start, name in zip(index.tolist(), (first - regions.bounds[index]).tolist(), names):
        docs = found[name]
        offset = int(regions.left[i]) - start
        # Window j of the piece starts `offset - j` words before the anchor; windows without the anchor are left to others.
        j, stop = max(0, offset - (WINDOW - GRAM)), min(len(docs), offset + 1)
        while j < stop:
            k = j + 1
            while k < stop and docs[k] == docs[j]:
                k += 1
            if docs[j] < regions.doc[i]:
                rows.append((i, offset - k + 1, offset - j, int(docs[j])))
            j = k
    columns = np.array(rows, np.int64).reshape(-1, 4)
    return columns[:, 0], columns[:, 1], columns[:, 2], columns[:, 3]


GRAIN = Grain(WINDOW, GRAM, lambda t: (t.words, t.word_bounds), lambda t: t.words, True, solve)


def dedup(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept, kept_sha256) of every row; `kept` are the kept words joined by one space.

    Windows are judged on the input. A null or empty text has no words and keeps none. A null id counts as larger than
    all others; rows with one id never remove each other's words. Repeated rows have equal results. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                total, gone, kept = [], [], []
                for text_, first, last in zip(*(rows.column(i) for i in (1, 2, 3))):
                    words = (text_.as_py() or "").encode().split()
                    total.append(len(words))
                    if first.is_valid and len(first):
                        away = covered(np.array(first.as_py()), np.array(last.as_py()), len(words))
                        words = list(compress(words, ~away))
                    gone.append(total[-1] - len(words))
                    kept.append(b" ".join(words))
                sums = [hashlib.sha256(k).hexdigest() for k in kept]
                columns = [rows.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array([k.decode() for k in kept], pa.string()), pa.array(sums, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_removed", "kept", "kept_sha256"])

    return applied(docs, spans(docs, GRAIN, doc, text), doc, text, run, "id long, n_words long, n_removed long, kept string, kept_sha256 string")
