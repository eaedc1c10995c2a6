"""Samples, splits and folds keyed by a hash of the row key.

Exact sizes come from cutoffs of the hash order: the rows themselves are not sorted or
shuffled, each row compares its own hash with its class's cutoffs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.functions.columns import hash_percent, quoted
from tabweave.plans.ordered import RowOrder, blocks_before, rank_cutoffs, take_by_class, take_smallest


def sample_n(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42, method: str = "md5") -> DataFrame:
    """Exactly n rows, or all if there are fewer."""
    return take_smallest(df, RowOrder(keys, seed, method), n)


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)


def split_by_bucket(df: DataFrame, keys: Sequence[str], test_percent: int = 20, seed: int = 42, method: str = "md5") -> DataFrame:
    """Add ``split`` by hash bucket alone: sizes are approximate, no statistics needed."""
    test = hash_percent([quoted(k) for k in keys], seed, method) < F.lit(test_percent)
    return df.withColumn("split", _named(test))


def _named(is_test: Column) -> Column:
    return F.when(is_test, F.lit("test")).otherwise(F.lit("train"))


def split_random(df: DataFrame, keys: Sequence[str], test_size: float = 0.2, seed: int = 42, method: str = "md5") -> DataFrame:
    """Add ``split``; the test part has exactly ceil(test_size * rows) rows."""
    order = RowOrder(keys, seed, method)
    cut = rank_cutoffs(df, order, lambda counts: {y: [_ceil(test_size * n)] for y, n in counts.items()})
    return blocks_before(df, cut, order).select(*_same(df), _named(F.col("_block") == 0).alias("split"))


def _same(df: DataFrame) -> list[Column]:
    return [quoted(c) for c in df.columns]


def _ceil(x: float) -> int:
    return math.ceil(round(x, 9))


def train_quotas(counts: dict[Any, int], test_size: float) -> dict[Any, int]:
    """Training rows per class: total fixed, shares by largest remainder (ties: smaller class value)."""
    total = sum(counts.values())
    wanted = total - _ceil(test_size * total)
    order = sorted(counts, key=lambda y: (y is not None, y))
    exact = {y: counts[y] * wanted / total for y in order}
    out = {y: math.floor(round(exact[y], 9)) for y in order}
    spare = wanted - sum(out.values())
    for y in sorted(order, key=lambda y: -round(exact[y] - out[y], 9))[:spare]:
        out[y] += 1
    return out


def split_stratified(
    df: DataFrame, keys: Sequence[str], label: str, test_size: float = 0.2, seed: int = 42, method: str = "md5"
) -> DataFrame:
    """Add ``split`` with the class ratio kept and the total test size exact."""

    def ranks(counts):
        train = train_quotas(counts, test_size)
        return {y: [counts[y] - train[y]] for y in counts}

    order = RowOrder(keys, seed, method)
    cut = rank_cutoffs(df, order, ranks, label)
    marked = blocks_before(df, cut, order, label)
    return marked.select(*_same(df), _named(F.col("_block") == 0).alias("split"))


def fold_sizes(counts: dict[Any, int], k: int) -> dict[Any, list[int]]:
    """Rows per class and fold: position p of the class-sorted rows counts for fold p mod k."""
    out, start = {}, 0
    for y in sorted(counts, key=lambda y: (y is not None, y)):
        n = counts[y]

        def upto(stop: int, i: int) -> int:
            return (stop - i + k - 1) // k if stop > i else 0

        out[y] = [upto(start + n, i) - upto(start, i) for i in range(k)]
        start += n
    return out


def stratified_folds(df: DataFrame, keys: Sequence[str], label: str, k: int = 5, seed: int = 42, method: str = "md5") -> DataFrame:
    """Add ``fold`` 0..k-1: contiguous blocks of each class in hash order."""
    if k < 2:
        raise ValueError("folds need k >= 2")

    def ranks(counts):
        out = {}
        for y, sizes in fold_sizes(counts, k).items():
            ends, at = [], 0
            for s in sizes[:-1]:
                at += s
                ends.append(at)
            out[y] = ends
        return out

    order = RowOrder(keys, seed, method)
    cut = rank_cutoffs(df, order, ranks, label)
    marked = blocks_before(df, cut, order, label)
    return marked.select(*_same(df), F.col("_block").cast("int").alias("fold"))


def plain_folds(df: DataFrame, keys: Sequence[str], k: int = 5, seed: int = 42, method: str = "md5") -> DataFrame:
    """Add ``fold`` for targets without classes: k contiguous blocks of the hash order."""

    def ranks(counts):
        n = counts.get(0, 0)
        sizes = [n // k + (1 if i < n % k else 0) for i in range(k)]
        return {0: [sum(sizes[: i + 1]) for i in range(k - 1)]} if n else {}

    order = RowOrder(keys, seed, method)
    cut = rank_cutoffs(df, order, ranks)
    marked = blocks_before(df, cut, order)
    return marked.select(*_same(df), F.col("_block").cast("int").alias("fold"))


def quota_sample(
    df: DataFrame, keys: Sequence[str], label: str, size: int = 500, seed: int = 42, method: str = "md5"
) -> DataFrame:
    """At most ``size`` rows, at most a quarter of them positive, negatives fill the rest."""
    y = quoted(label)

    def quotas(counts: dict) -> dict:
        total = min(size, sum(counts.values()))
        positives = min(counts.get(1, 0), total // 4)
        return {1: positives, 0: min(counts.get(0, 0), total - positives)}

    cls = F.when(y == 1, F.lit(1)).when(y == 0, F.lit(0))
    return take_by_class(df, RowOrder(keys, seed, method), cls, quotas)


def first_of_each_class(df: DataFrame, label: str, order_by: Sequence[str]) -> DataFrame:
    """The first positive and the first negative row along ``order_by``, marked by ``wanted``.

    Without a positive row the first row overall stands in, without a negative one the second.
    """
    order = [quoted(c) for c in order_by]
    y = quoted(label)
    seen = df.agg(F.count_if(y == 1).alias("p"), F.count_if(y == 0).alias("q")).first()
    positive = df.where(y == 1) if seen["p"] else df
    first = positive.orderBy(*order).limit(1)
    if seen["q"]:
        second = df.where(y == 0).orderBy(*order).limit(1)
    else:
        second = df.orderBy(*order).limit(2).orderBy(*[c.desc() for c in order]).limit(1)
    return first.select(F.lit(1).alias("wanted"), "*").unionByName(second.select(F.lit(0).alias("wanted"), "*"))
