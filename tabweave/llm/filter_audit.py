"""How filters that are applied one after another share the documents they remove, in every order.

Each filter has, for each part of the table, the sorted list of the rows that fail it. What a filter removes after others is
its list without the union of theirs, so an audit of all orders needs the sizes of the differences between each list and
each union of other lists. The lists are held by id range: rows are dealt to tasks by part and id, a task takes a few
thousand rows at a time, merges the lists of that range (the shorter of two is sought in the longer by galloping) and adds
the sizes up; sizes of ranges are sums. Orders come in only at the end, as a table of steps that is as long for any input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabweave.llm.arrays import Texts, per_text, text_of, texts
from tabweave.plans.lookup import key_bytes, lookup_join
from tabweave.session import written

FILTERS = "ABCDE"
#: More filters would have too many orders to list them all.
MOST_FILTERS = 7
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#$%&*|"]] = True


def distinct_words(t: Texts) -> np.ndarray:
    """Number of different words of each text."""
    words, bounds = t.words, t.word_bounds
    if not len(words):
        return np.zeros(len(t), np.int64)
    text = text_of(np.arange(len(words)), bounds)
    by = np.lexsort((words, text))
    new = np.ones(len(by), bool)
    new[1:] = (words[by][1:] != words[by][:-1]) | (text[by][1:] != text[by][:-1])
    return np.bincount(text[by[new]], minlength=len(t)).astype(np.int64)


def own_mask(t: Texts) -> np.ndarray:
    """Bits of the filters A to D that each text fails; they look at the text alone."""
    n = np.diff(t.word_bounds).astype(np.int64)
    points = per_text((t.data & 0xC0) != 0x80, t.bounds)
    capitals = per_text((t.data >= 65) & (t.data <= 90), t.bounds)
    fails = [n < 50, 100 * distinct_words(t) < 65 * n, 100 * capitals > 5 * points, per_text(SYMBOLS[t.data], t.bounds) > 0]
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def failures(docs: DataFrame, doc: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, id, mask, row) of every document: bit k of `mask` tells whether it fails filter k of ABCDE.

    A fails under 50 words, B under 65 % different words, C over 5 % capital letters, D with a symbol of `#$%&*|`, E where a
    smaller id has the same text. A null text is empty, a null part the empty string. A null id is smaller and larger than
    none: it never fails E and makes no other document fail. Rows that share an id each count, none is a copy of the other.
    `row` numbers the rows. Other columns are not read.
    """
    source = docs.select(docs[doc].cast("bigint").alias("id"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"), docs[text].cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts(batch.column(2)):
                rows = batch.slice(t.first, len(t))
                cells = [t.data[a:b].tobytes() for a, b in zip(t.bounds[:-1], t.bounds[1:])]
                digest = pa.array([hashlib.blake2b(c, digest_size=16).digest() for c in cells], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(own_mask(t), pa.int32()), digest], names=["id", "part", "mask", "digest"])

    own = written(source.mapInArrow(run, "id long, part string, mask int, digest binary").withColumn("row", F.monotonically_increasing_id()), "own-failures")
    shared = own.groupBy(F.col("digest").alias("_key")).agg(F.min("id").alias("_v"), F.count("*").alias("_n"), F.max("id").alias("last"))
    shared = written(shared.where("last > _v").drop("last"), "equal-texts")
    total = shared.agg(F.sum("_n")).first()[0] or 0
    marked = lookup_join(own, shared, "digest", key_bytes(shared), total)
    late = F.coalesce(F.col("id") > F.col("_v"), F.lit(False)).cast("int")
    return marked.select("part", "id", F.col("mask").bitwiseOR(late * 16).alias("mask"), "row")


def marked(rows: DataFrame, labels: DataFrame, doc: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """The rows with `good` and `toxic` (0 or 1): whether any row of `labels` for their id says so. No label is 0."""
    says = [F.max(F.coalesce((labels[c] == 1).cast("int"), F.lit(0))).alias(n) for c, n in ((quality, "good"), (toxic, "toxic"))]
    known = written(labels.where(labels[doc].isNotNull()).groupBy(labels[doc].cast("bigint").alias("_doc")).agg(*says), "labels")
    found = rows.join(known, rows["id"] == F.col("_doc"), "left")
    return found.select(*rows.columns, *[F.coalesce(n, F.lit(0)).alias(n) for n in ("good", "toxic")])


def union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of two sorted lists, the ids in either; the shorter is sought in the longer."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not len(short):
        return long
    at = np.searchsorted(long, short)
    new = np.append(long, -1)[at] != short
    return np.insert(long, at[new], short[new])


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The ids of the first sorted list that are not in the second; the shorter is sought in the longer."""
    if not len(a) or not len(b):
        return a
    if len(a) <= len(b):
        return a[np.append(b, -1)[np.searchsorted(b, a)] != a]
    at = np.searchsorted(a, b)
    return np.delete(a, at[np.append(a, -1)[at] == b])


def cells(k: int) -> list[tuple[int, int]]:
    """(filter, set of other filters as bits) of every difference that an audit of k filters needs."""
    return [(f, s) for f in range(k) for s in range(1 << k) if not s >> f & 1]


def range_sizes(mask: np.ndarray, marks: list[np.ndarray], k: int) -> np.ndarray:
    """Sizes over one id range, a row per cell: removed, removed with each mark, reached by filter and set, failing the filter."""
    lists = [np.flatnonzero(mask >> f & 1) for f in range(k)]
    unions = [np.zeros(0, np.int64)] * (1 << k)
    for s in range(1, 1 << k):
        low = (s & -s).bit_length() - 1
        unions[s] = union(unions[s & (s - 1)], lists[low])
    out = []
    for f, s in cells(k):
        left = difference(lists[f], unions[s])
        out.append([len(left), *[int(m[left].sum()) for m in marks], len(unions[s | 1 << f]), len(lists[f])])
    return np.array(out, np.int64)


def audit(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, zeros included: what the filter of that step does to the part.

    rows: (part, id, mask, row, good, toxic), `row` unique (it deals out rows of equal or null id). Counts, all of rows:
    `kept` after the step, `removed` by it, `redundant` (fail its filter but are gone), `unique_fails` (fail no other
    filter), `good_lost` and `toxic_lost` of the removed, `shapley` (removed by that filter, summed over all orders). A part
    without rows has no rows here; an empty table gives none. At most MOST_FILTERS filters, each a letter of its own.
    """
    k = len(filters)
    if not 0 < k <= MOST_FILTERS or len(set(filters)) < k:
        raise ValueError(f"give 1 to {MOST_FILTERS} different letters")
    cell = np.array(cells(k), np.int32)
    names = ["part", "filter", "before", "removed", "good_lost", "toxic_lost", "reached", "size", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(part: str, total: np.ndarray, n: int) -> pa.RecordBatch:
            columns = [pa.array([part] * len(cell), pa.string()), pa.array(cell[:, 0]), pa.array(cell[:, 1])]
            return pa.RecordBatch.from_arrays([*columns, *[pa.array(c) for c in total.T], pa.array(np.full(len(cell), n, np.int64))], names=names)

        part, total, n = None, None, 0
        for batch in batches:
            parts = batch.column(0).dictionary_encode()
            code = parts.indices.to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else []
            mask, *marks = (batch.column(i).to_numpy() for i in (1, 2, 3))
            for a, b in zip(starts, [*starts[1:], len(code)]):
                here = parts.dictionary[code[a]].as_py()
                if here != part and n:
                    yield rows_of(part, total, n)
                    n = 0
                sizes = range_sizes(mask[a:b], [m[a:b] for m in marks], k)
                part, total, n = here, sizes if not n else total + sizes, n + int(b - a)
        if n:
            yield rows_of(part, total, n)

    ranges = rows.repartitionByRange("part", "id", "row").sortWithinPartitions("part", "id", "row").select("part", "mask", "good", "toxic")
    schema = "part string, filter int, before int, " + ", ".join(f"{c} long" for c in names[3:])
    sums = ranges.mapInArrow(run, schema).groupBy("part", "filter", "before").agg(*[F.sum(c).alias(c) for c in names[3:]])
    set_size = F.bit_count("before")
    orders = F.element_at(F.array(*[F.lit(factorial(m) * factorial(k - 1 - m)) for m in range(k)]), set_size + 1)
    own = Window.partitionBy("part", "filter")
    sums = sums.withColumns(
        {"shapley": F.sum(F.col("removed") * orders).over(own), "unique_fails": F.max(F.when(set_size == k - 1, F.col("removed"))).over(own)}
    )
    steps = [("".join(filters[f] for f in o), i + 1, o[i], sum(1 << f for f in o[:i])) for o in permutations(range(k)) for i in range(k)]
    table = rows.sparkSession.createDataFrame(steps, "filter_order string, step int, filter int, before int")
    return sums.join(F.broadcast(table), ["filter", "before"]).select(
        "part", "filter_order", "step", (F.col("n") - F.col("reached")).alias("kept"), "removed", (F.col("size") - F.col("removed")).alias("redundant"),
        "unique_fails", "good_lost", "toxic_lost", "shapley",
    )


def interactions(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """The audit of the five filters over all documents, by the values of a column; rules as for `failures` and `marked`."""
    rows = marked(failures(docs, doc, text, part), labels)
    return audit(written(rows, "failures"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
     same AS (SELECT t AS st, min(doc_id) AS least FROM d GROUP BY t),
     said AS (SELECT doc_id AS li, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
     w AS (SELECT d.*, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
     f AS (SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
             CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
           + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask
           FROM w LEFT JOIN same ON st = t LEFT JOIN said ON li = doc_id),
     g AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM f GROUP BY part, mask),
     l AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(x, b)),
     o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits FROM l a, l b, l c, l d, l e
           WHERE a.b + b.b + c.b + d.b + e.b = 31 AND len(list_distinct([a.b, b.b, c.b, d.b, e.b])) = 5),
     s AS (SELECT filter_order, CAST(i AS INTEGER) AS step, bits[i] AS bit, CAST(coalesce(list_sum(bits[1:i - 1]), 0) AS INTEGER) AS before FROM o, range(1, 6) r(i)),
     p AS (SELECT part, filter_order, step, bit,
             sum(CASE WHEN mask & (before + bit) = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN bad ELSE 0 END) AS toxic_lost
           FROM g, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM p
"""
