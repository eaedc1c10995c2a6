"""Token counts of a byte-level BPE by two tiers of known pre-token lengths.

A first pass counts pre-tokens inside each task with a bounded table and keeps the most frequent ones of all tasks; the
lengths of those are broadcast (at most `frequent` entries of at most `LONGEST` characters). A second pass adds lengths
up: frequent pre-tokens from the broadcast table, others from a bounded cache of the worker, what neither knows from the
tokenizer itself. Only the bounded tables of the tasks are shuffled, never pre-tokens.

Texts with a special string, or with characters whose class may differ between versions of Unicode, go to the tokenizer
whole, so that counts are always the tokenizer's own.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONGEST = 48
CACHE = 1 << 18
COUNTED = 1 << 16
SENT = 1 << 13
#: The pre-token pattern of the byte-level vocabulary (its published form, with the classes of the `re` module).
PRE_TOKEN = r"'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
#: Characters whose classes `re` and the tokenizer agree on: ASCII without the four separators, Latin, Greek, Cyrillic, common punctuation.
DOUBTFUL = r"[^\x00-\x1b\x20-\x7e¡-±´-¸º»¿-ɏΑ-ΡΣ-ώА-џ‐-‧]"


@lru_cache(maxsize=2)
def _tokenizer(text: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(text)


def _reader(vocabulary: str):
    """The tokenizer, the pre-token finder and a test of whether a text must go to the tokenizer whole."""
    import re

    tokenizer = _tokenizer(vocabulary)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    whole = re.compile("|".join([DOUBTFUL, *map(re.escape, special)]))
    return tokenizer, re.compile(PRE_TOKEN).findall, whole.search


def _lengths(tokenizer, strings: list[str]) -> list[int]:
    return [len(e) for e in tokenizer.encode_batch(strings, add_special_tokens=False)]


def _parts(column: pa.Array) -> Iterator[list[str]]:
    """Texts in lists of a bounded number; null is empty."""
    for at in range(0, len(column), 256):
        yield [x or "" for x in column.slice(at, 256).to_pylist()]


def frequent_lengths(texts: DataFrame, shared, frequent: int) -> dict[str, int]:
    """Lengths of the pre-tokens that all texts (the one column) hold most often. shared: broadcast tokenizer file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, find, whole = _reader(shared.value)
        seen: Counter[str] = Counter()
        for batch in batches:
            for part in _parts(batch.column(0)):
                for x in part:
                    if not whole(x):
                        seen.update(find(x))
                if len(seen) > 4 * COUNTED:
                    seen = Counter(dict(seen.most_common(COUNTED)))
        top = [(k, v) for k, v in seen.most_common(SENT) if len(k) <= LONGEST]
        yield pa.RecordBatch.from_pydict({"token": pa.array([k for k, _ in top], pa.string()), "n": pa.array([v for _, v in top], pa.int64())})

    counted = texts.mapInArrow(run, "token string, n long")
    top = counted.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(frequent)
    tokens = [r.token for r in top.collect()]
    return dict(zip(tokens, _lengths(_tokenizer(shared.value), tokens))) if tokens else {}


def count_tokens(
    docs: DataFrame, vocabulary: str, keys: tuple[str, ...] = ("doc_id",), text: str = "text", limit: int = 512, frequent: int = 1 << 15
) -> DataFrame:
    """Key columns of every row with `n_bytes`, `n_tokens` and `over_limit` (more than `limit` tokens).

    vocabulary: path of a tokenizer file on the driver; its content is broadcast. Special strings inside texts count as the
    tokenizer counts them by default; none are added. A null text is empty: 0 bytes, 0 tokens. Repeated rows are counted
    alike, each by itself; other columns are not read.
    """
    content = Path(vocabulary).read_text(encoding="utf-8")
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(content)
    source = docs.select(*[docs[k] for k in keys], docs[text].cast("string").alias("_text"))
    table = context.broadcast(frequent_lengths(source.select("_text"), shared, frequent))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    names = [*keys, "n_bytes", "n_tokens", "over_limit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, find, whole = _reader(shared.value)
        known, cache = table.value, {}
        for batch in batches:
            done = 0
            for part in _parts(batch.column(len(keys))):
                split = [None if whole(x) else find(x) for x in part]
                missing = list({t for tokens in split if tokens for t in tokens if t not in known and t not in cache})
                if len(cache) + len(missing) > CACHE:
                    cache = {}
                    missing = list({t for tokens in split if tokens for t in tokens if t not in known})
                found = dict(zip(missing, _lengths(tokenizer, missing)))
                cache.update((k, v) for k, v in found.items() if len(k) <= LONGEST)
                counts = []
                for x, tokens in zip(part, split):
                    if tokens is None:
                        counts.append(_lengths(tokenizer, [x])[0])
                        continue
                    n = 0
                    for t in tokens:
                        n += known.get(t) or cache.get(t) or found[t]
                    counts.append(n)
                rows = batch.slice(done, len(part))
                done += len(part)
                sizes = pa.array([len(x.encode()) for x in part], pa.int64())
                columns = [rows.column(i) for i in range(len(keys))]
                yield pa.RecordBatch.from_arrays([*columns, sizes, pa.array(counts, pa.int64()), pa.array([c > limit for c in counts])], names=names)

    return source.mapInArrow(run, f"{head}, n_bytes long, n_tokens long, over_limit boolean")
