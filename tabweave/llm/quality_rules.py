"""Quality rules: size, symbols, repeated lines and words, and repetition found with a suffix array of the words.

Every text gets a suffix array of its words by prefix doubling (all texts of a chunk at once, only suffixes that are
still tied take part in a round). Longest common prefixes of neighbours follow from the ranks that the rounds leave
behind. An interval of neighbours whose common prefix has `min_repeat` words or more is a repeated passage; the union
of their spans gives the covered fraction, the longest prefix the longest repeat. Both are limited.

Work and memory follow a chunk or the longest text. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabweave.llm.arrays import Texts, covered, per_text, runs, span_hash, text_of, texts

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered_words long, longest_repeat long"
SCHEMA = f"{MEASURES}, base_failed boolean, kept boolean"


@dataclass(frozen=True)
class Limits:
    """A text fails with fewer than `min_words` words, with more than `max_repeat_percent` of its words in repeated windows
    of `window` words, with more than `max_covered_percent` of its words in repeated passages of `min_repeat` words or
    more, or with a repeated passage of more than `max_longest` words."""

    min_words: int = 50
    window: int = 3
    max_repeat_percent: int = 50
    min_repeat: int = 20
    max_covered_percent: int = 30
    max_longest: int = 50


def rank_levels(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of all texts (text by text), and at level j the rank of each suffix by its first 2**j words.

    Suffixes that end within the compared words differ from all others, so ranks are equal for equal runs only.
    """
    n = len(words)
    text = text_of(np.arange(n), bounds)
    end = bounds[1:][text]
    order = np.lexsort((words, text))
    new = np.ones(n, bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (text[order][1:] != text[order][:-1])
    start = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(start, np.diff(np.append(start, n)))
    levels, width = [rank], 1
    tied = order[~(new & np.append(new[1:], True))]
    while len(tied):
        rank = rank.copy()
        after = tied + width
        inside = after < end[tied]
        key = np.where(inside, levels[-1][np.minimum(after, n - 1)] + 1, 0)
        by = np.lexsort((key, levels[-1][tied]))
        tied, key = tied[by], key[by]
        old = levels[-1][tied]
        group = np.ones(len(tied), bool)
        group[1:] = old[1:] != old[:-1]
        new = group.copy()
        new[1:] |= key[1:] != key[:-1]
        new |= key == 0
        at = np.arange(len(tied))
        first = np.maximum.accumulate(np.where(group, at, 0))
        rank[tied] = old + np.maximum.accumulate(np.where(new, at, 0)) - first
        levels.append(rank)
        width *= 2
        tied = tied[~(new & np.append(new[1:], True))]
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray], least: int) -> np.ndarray:
    """Words that each suffix shares with its forerunner in the array; 0 where they are fewer than `least`."""
    out = np.zeros(len(order), np.int64)
    level = least.bit_length() - 1
    if len(order) < 2 or len(levels) <= level:
        return out
    pair = np.flatnonzero(levels[level][order[1:]] == levels[level][order[:-1]]) + 1
    a, b = order[pair].copy(), order[pair - 1].copy()
    length = np.zeros(len(pair), np.int64)
    n = len(order)
    for j in range(len(levels) - 1, -1, -1):
        inside = np.maximum(a, b) < n
        same = inside & (levels[j][np.minimum(a, n - 1)] == levels[j][np.minimum(b, n - 1)])
        step = same.astype(np.int64) << j
        a, b, length = a + step, b + step, length + step
    out[pair] = np.where(length >= least, length, 0)
    return out


def repetition(words: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text inside passages of `least` words or more that occur again in it, and the longest such passage."""
    zero = np.zeros(len(bounds) - 1, np.int64)
    if len(words) < 2:
        return zero, zero.copy()
    order, levels = rank_levels(words, bounds)
    common = common_prefixes(order, levels, least)
    longest = np.maximum(common, np.append(common[1:], 0))
    found = np.flatnonzero(longest)
    first, length = order[found], longest[found]
    most = zero.copy()
    np.maximum.at(most, text_of(first, bounds), length)
    return per_text(covered(first, first + length, len(words)), bounds), most


def repeated_windows(words: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Words of each text in windows of `size` words that are found twice or more in it."""
    first, run = runs(words, bounds, size)
    if not len(first):
        return np.zeros(len(bounds) - 1, np.int64)
    text = text_of(first, bounds)
    by = np.lexsort((run, text))
    same = (run[by][1:] == run[by][:-1]) & (text[by][1:] == text[by][:-1])
    twice = np.zeros(len(by), bool)
    twice[1:] |= same
    twice[:-1] |= same
    at = first[by[twice]]
    return per_text(covered(at, at + size, len(words)), bounds)


def repeated_lines(t: Texts) -> np.ndarray:
    """Lines of each text that hold a word and equal an earlier line."""
    if not len(t.data):
        return np.zeros(len(t), np.int64)
    breaks = np.flatnonzero(t.data == 10)
    first = np.union1d(t.bounds[:-1], breaks + 1)
    first = first[first < len(t.data)]
    last = np.append(first[1:], len(t.data))
    last -= (t.data[last - 1] == 10).astype(np.int64)
    starts = t.spans[0]
    full = np.searchsorted(starts, last) > np.searchsorted(starts, first)
    first, last = first[full], last[full]
    text, line = text_of(first, t.bounds), span_hash(t.byte_sums, first, last)
    by = np.lexsort((first, line, text))
    again = np.flatnonzero((line[by][1:] == line[by][:-1]) & (text[by][1:] == text[by][:-1])) + 1
    return np.bincount(text[by[again]], minlength=len(t)).astype(np.int64)


def measures(t: Texts, limits: Limits) -> dict[str, np.ndarray]:
    """The measures of each text of a chunk and the two verdicts."""
    first, last = t.spans
    bounds = t.word_bounds
    n = np.diff(bounds).astype(np.int64)
    starts = np.concatenate(([0], np.cumsum((t.data & 0xC0) != 0x80, dtype=np.int64)))
    repeat = repeated_windows(t.words, bounds, limits.window)
    cover, longest = repetition(t.words, bounds, limits.min_repeat)
    failed = (n < limits.min_words) | (100 * repeat > limits.max_repeat_percent * n)
    return {
        "n_words": n,
        "word_chars": per_text(starts[last] - starts[first], bounds),
        "n_symbols": per_text(SYMBOLS[t.data], t.bounds),
        "n_dup_lines": repeated_lines(t),
        "n_repeat_words": repeat,
        "covered_words": cover,
        "longest_repeat": longest,
        "base_failed": failed,
        "kept": ~(failed | (100 * cover > limits.max_covered_percent * n) | (longest > limits.max_longest)),
    }


def score(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Key columns of every row with its measures and verdicts.

    A null or empty text has no words, so it fails. Repeated rows are scored alike, each by itself. Other columns are
    not read; their names may be anything.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.slice(0, batch.num_rows)
            for t in texts(batch.column(batch.num_columns - 1)):
                rows = kept.slice(t.first, len(t))
                columns = [rows.column(i) for i in range(len(keys))] + [pa.array(v) for v in measures(t, limits).values()]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    source = docs.select(*[docs[k] for k in keys], docs[text].cast("string").alias("_text"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    names = [*keys, *[c.split()[0] for c in SCHEMA.split(", ")]]
    return source.mapInArrow(run, f"{head}, {SCHEMA}")


def keep_good(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns unchanged."""
    schema = docs.schema
    position = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts(batch.column(position)):
                yield batch.slice(t.first, len(t)).filter(pa.array(measures(t, limits)["kept"]))

    return docs.mapInArrow(run, schema)
