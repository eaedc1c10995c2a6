"""Ranked lexical search over an index of K2-treaps.

The index cuts the documents into shards. A shard is a grid of terms (rows, frequent ones first) by documents (columns, by
length); a cell holds the impact of its term on its document. The grid is stored as a quadtree by level: one nibble per
inner node says which of its quadrants hold anything, and every node knows the largest impact below it; it is written down
once, for the highest node that has it. A search for an item
walks down the paths of all its rows at once: a state is a range of documents with one node per term, its bound the sum of
the terms' weights times their nodes' maxima. States are taken in the order of their bounds, some at a time, until none left
can reach the item's best results so far. Maxima are free of the terms' weights, which depend on counts over all documents and
come with the search.

Score of a document: sum over the item's different terms of w * ((1000000000 * tf) div (1000 * tf + 20 * m)), where w is
floor(1000 * ln((2N + 2) / (2 df + 1))) and m is 50 + (50 * n * N) div L; N counts the documents with a term, L their terms,
n those of the document, df the documents that hold the term.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabweave.llm.arrays import Texts, span_hash, texts
from tabweave.session import fresh_dir

#: Text of one shard; a longer document is a shard of its own.
SHARD_BYTES = 8 << 20
#: States that one step of a search takes at once.
AT_ONCE = 32
#: Terms of all items that one pass of a search broadcasts, 16 bytes each.
PASS_TERMS = 1 << 20
TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
INDEX = "docs array<long>, terms binary, counts binary, height int, nodes binary, maxima binary"
COUNT = np.array([bin(i).count("1") for i in range(16)], np.int32)
#: Children before quadrant q of a node with a nibble.
BEFORE = np.array([[bin(i & ((1 << q) - 1)).count("1") for q in range(4)] for i in range(16)], np.int32)


@dataclass
class Terms(Texts):
    """Texts whose words are the terms of the search: runs of ASCII letters and digits and of all other characters."""

    @property
    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        term = TERM[self.data]
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.bounds] = True
        before = np.concatenate(([False], term[:-1])) & ~edge[:-1]
        after = np.concatenate((term[1:], [False])) & ~edge[1:]
        return np.flatnonzero(term & ~before[: len(term)]), np.flatnonzero(term & ~after[: len(term)]) + 1


def term_hashes(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term of a chunk, only A-Z lower-cased, and the bounds of each text's terms."""
    low = t.lowered()
    terms = Terms(low.first, low.data, low.bounds)
    first, last = terms.spans
    return span_hash(terms.byte_sums, first, last), np.searchsorted(first, t.bounds)


def totals(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """N and L: how many documents have a term, and how many terms there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = total = 0
        for batch in batches:
            for t in texts(batch.column(0)):
                term = TERM[t.data]
                starts = term & ~np.concatenate(([False], term[:-1]))[: len(term)]
                starts[t.bounds[:-1][t.bounds[:-1] < len(term)]] |= term[t.bounds[:-1][t.bounds[:-1] < len(term)]]
                own = np.add.reduceat(np.append(starts, 0), t.bounds[:-1], dtype=np.int64) * (np.diff(t.bounds) > 0)
                n, total = n + int((own > 0).sum()), total + int(own.sum())
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "total": pa.array([total], pa.int64())})

    row = docs.select(docs[text].cast("string").alias("_text")).mapInArrow(run, "n long, total long").agg(F.sum("n"), F.sum("total")).first()
    return row[0] or 0, row[1] or 0


def spread(x: np.ndarray) -> np.ndarray:
    """Bits of 32-bit numbers, each followed by a zero."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def treap(row: np.ndarray, column: np.ndarray, value: np.ndarray, height: int) -> tuple[np.ndarray, np.ndarray]:
    """Inner nodes and maxima of a grid of 2^height by 2^height with at least one cell, level by level from the root.

    A byte per inner node: its nibble, and above it the quadrant that has its maximum. Of the maxima only the root's and those
    of the other quadrants are kept.
    """
    code = spread(row) << np.uint64(1) | spread(column)
    by = np.argsort(code)
    code, most = code[by], value[by].astype(np.int32)
    nodes, maxima = [], []
    for _ in range(height):
        parent, quadrant = code >> np.uint64(2), (code & np.uint64(3)).astype(np.uint8)
        start = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1])))
        above = np.maximum.reduceat(most, start)
        group = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(code))))
        equal = np.flatnonzero(most == above[group])
        best = equal[np.concatenate(([True], group[equal][1:] != group[equal][:-1]))]
        nodes.append(np.bitwise_or.reduceat(np.uint8(1) << quadrant, start).astype(np.uint8) | quadrant[best] << np.uint8(4))
        maxima.append(np.delete(most, best))
        code, most = parent[start], above
    return np.concatenate(nodes[::-1]), np.concatenate([most, *maxima[::-1]])


def unfolded(nodes: np.ndarray, kept: np.ndarray, height: int) -> np.ndarray:
    """Maxima of all nodes, level by level from the root, from what `treap` keeps."""
    nibbles, best = nodes & 15, nodes >> 4
    levels, at, used, above = [kept[:1]], 0, 1, kept[:1]
    for _ in range(height):
        nibble = nibbles[at : at + len(above)]
        count = COUNT[nibble]
        first = np.cumsum(count) - count
        most = np.repeat(above, count)
        other = np.ones(len(most), bool)
        other[first + BEFORE[nibble, best[at : at + len(above)]]] = False
        n = len(most) - len(above)
        most[other] = kept[used : used + n]
        levels.append(most)
        at, used, above = at + len(above), used + n, most
    return np.concatenate(levels)


class Shard:
    """Terms of a shard's documents as they come in, and its row of the index."""

    def __init__(self, n_docs: int, n_terms: int) -> None:
        self.n, self.total = n_docs, n_terms
        self.docs, self.lengths, self.size = [], [], 0
        self.at, self.hashes, self.tf = [], [], []

    def add(self, ids: list, t: Texts) -> None:
        hashes, bounds = term_hashes(t)
        doc = np.repeat(np.arange(len(t)), np.diff(bounds))
        by = np.lexsort((hashes, doc))
        hashes, doc = hashes[by], doc[by]
        start = np.flatnonzero(np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])))[: len(by)])
        self.at.append((doc[start] + len(self.docs)).astype(np.int32))
        self.hashes.append(hashes[start])
        self.tf.append(np.diff(np.append(start, len(by))).astype(np.int32))
        self.docs += ids
        self.lengths.append(np.diff(bounds))
        self.size += len(t.data)

    def row(self) -> dict:
        n = np.concatenate(self.lengths).astype(np.int64)
        order = np.argsort(n, kind="stable")
        column = np.empty(len(n), np.int32)
        column[order] = np.arange(len(n), dtype=np.int32)
        at, tf = np.concatenate(self.at), np.concatenate(self.tf).astype(np.int64)
        terms, term = np.unique(np.concatenate(self.hashes), return_inverse=True)
        counts = np.bincount(term, minlength=len(terms))
        place = np.empty(len(terms), np.int64)
        place[np.argsort(-counts, kind="stable")] = np.arange(len(terms))
        m = 50 + (50 * n * self.n) // max(1, self.total)
        value = (1_000_000_000 * tf) // (1000 * tf + 20 * m[at])
        height = max(1, int(max(len(terms), len(n)) - 1).bit_length())
        nodes, maxima = treap(place[term], column[at], value, height)
        # Terms in the order of their rows; the rows' counts are what the shard adds to df.
        by = np.argsort(place)
        return {
            "docs": [self.docs[i] for i in order],
            "terms": terms[by].tobytes(),
            "counts": counts[by].astype(np.int32).tobytes(),
            "height": height,
            "nodes": nodes.tobytes(),
            "maxima": maxima.tobytes(),
        }


def build(docs: DataFrame, doc: str = "doc_id", text: str = "text", counted: tuple[int, int] | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index of all documents, one row per shard; write it once, then search it as often as needed.

    counted: N and L, counted in a pass of its own if not given. A shard holds documents of one task with about `shard_bytes`
    of text, so nothing is shuffled and a very long text is a shard of its own. Null texts and texts without a term are in no
    shard. Repeated rows, and rows that share an id, are indexed each; null ids stay null. Other columns are not read.
    """
    n_docs, n_terms = counted or totals(docs, text)
    source = docs.select(docs[doc].cast("bigint").alias("id"), docs[text].cast("string").alias("_text")).where("_text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("docs", pa.list_(pa.int64())), *[(c, pa.binary()) for c in ("terms", "counts")], ("height", pa.int32()), *[(c, pa.binary()) for c in ("nodes", "maxima")]])
        shard = Shard(n_docs, n_terms)
        for batch in batches:
            for t in texts(batch.column(1)):
                if shard.docs and shard.size + len(t.data) > shard_bytes:
                    yield pa.RecordBatch.from_pylist([shard.row()] if sum(map(len, shard.at)) else [], schema)
                    shard = Shard(n_docs, n_terms)
                shard.add(batch.column(0).slice(t.first, len(t)).to_pylist(), t)
        if shard.docs and sum(map(len, shard.at)):
            yield pa.RecordBatch.from_pylist([shard.row()], schema)

    return source.mapInArrow(run, INDEX)


def write_index(index: DataFrame) -> DataFrame:
    """The index written to the shared folder and read back; zstd halves it."""
    path = fresh_dir(index.sparkSession, "treaps")
    index.write.option("compression", "zstd").parquet(path)
    return index.sparkSession.read.parquet(path)


class Treap:
    """One shard of the index, ready for searches."""

    def __init__(self, docs: np.ndarray, missing: np.ndarray, terms: bytes, height: int, nodes: bytes, maxima: bytes) -> None:
        self.docs, self.missing, self.height = docs, missing, height
        self.terms = np.frombuffer(terms, np.uint64)
        nodes = np.frombuffer(nodes, np.uint8)
        self.nibbles, self.maxima = nodes & 15, unfolded(nodes, np.frombuffer(maxima, np.int32), height)
        #: Number of the first child; children of a level's nodes follow each other in the next level.
        self.first = np.concatenate(([0], np.cumsum(COUNT[self.nibbles], dtype=np.int32)))[:-1].astype(np.int32) + 1

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each term of sorted hashes, -1 where the shard has none."""
        by = np.argsort(self.terms)
        at = np.searchsorted(self.terms, hashes, sorter=by)
        row = by[np.minimum(at, len(by) - 1)]
        return np.where(self.terms[row] == hashes, row, -1)

    def search(self, rows: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Offer `best` every document that may belong to it."""
        k = len(rows)
        level, start = np.zeros(1, np.int32), np.zeros(1, np.int64)
        node = np.zeros((1, k), np.int32)
        bound = np.array([int(weights.sum()) * int(self.maxima[0])])
        quadrant = np.arange(2)
        while len(bound):
            live = bound >= best.floor
            if not live.all():
                level, start, node, bound = level[live], start[live], node[live], bound[live]
            if len(bound) > AT_ONCE:
                take = np.argpartition(-bound, AT_ONCE - 1)[:AT_ONCE]
                rest = np.ones(len(bound), bool)
                rest[take] = False
            else:
                take, rest = np.arange(len(bound)), np.zeros(len(bound), bool)
            deep, at, path = level[take], start[take], node[take]
            bit = (rows[None, :] >> (self.height - 1 - deep)[:, None]) & 1
            nibble = np.where(path >= 0, self.nibbles[path], 0)
            q = 2 * bit[:, :, None] + quadrant
            child = np.where(nibble[:, :, None] >> q & 1, self.first[path][:, :, None] + BEFORE[nibble[:, :, None], q], -1)
            reach = (np.where(child >= 0, self.maxima[child], 0) * weights[:, None]).sum(axis=1)
            child = child.transpose(0, 2, 1).reshape(-1, k)
            deep = np.repeat(deep + 1, 2)
            half = np.int64(1) << (self.height - deep).astype(np.int64)
            at = np.repeat(at, 2) + np.tile(quadrant, len(take)) * half
            reach = reach.ravel()
            good = (reach > 0) & (reach >= best.floor)
            done = good & (deep == self.height)
            if done.any():
                column = at[done]
                best.offer(reach[done], self.docs[column], self.missing[column])
            good &= deep < self.height
            level, start = np.concatenate((level[rest], deep[good])), np.concatenate((start[rest], at[good]))
            node, bound = np.concatenate((node[rest], child[good])), np.concatenate((bound[rest], reach[good]))


class Best:
    """The best documents of one item so far: highest score first, then smallest id, null ids last."""

    def __init__(self, k: int) -> None:
        self.k, self.floor = k, 1
        self.score, self.doc, self.missing = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def offer(self, score: np.ndarray, doc: np.ndarray, missing: np.ndarray) -> None:
        score, doc, missing = np.concatenate((self.score, score)), np.concatenate((self.doc, doc)), np.concatenate((self.missing, missing))
        by = np.lexsort((doc, missing, -score))[: self.k]
        self.score, self.doc, self.missing = score[by], doc[by], missing[by]
        if len(by) == self.k:
            self.floor = max(1, int(self.score[-1]))


@dataclass
class Asked:
    """Items of one pass: sorted hashes of their terms, the terms' weights, and per item its terms by number."""

    names: list
    hashes: np.ndarray
    weights: np.ndarray
    bounds: np.ndarray
    terms: np.ndarray


def item_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """(item, number, terms): different terms of each item's text; items that are equal in id and text are one."""
    distinct = items.select(items[item].alias("item"), items[text].cast("string").alias("_text")).where("_text IS NOT NULL").distinct()
    head = f"item {distinct.schema['item'].dataType.simpleString()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts(batch.column(1)):
                hashes, bounds = term_hashes(t)
                own = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
                found = pa.array([x.tobytes() for x in own], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(t.first, len(t)), found], names=["item", "terms"])

    return distinct.mapInArrow(run, f"{head}, terms binary").where("octet_length(terms) > 0")


def passes(found: DataFrame, most: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Names and terms of the items in passes of at most `most` terms; an item with more is a pass of its own."""
    names, own, size = [], [], 0
    for row in found.toLocalIterator():
        terms = np.frombuffer(bytes(row.terms), np.uint64)
        if names and size + len(terms) > most:
            yield names, own
            names, own, size = [], [], 0
        names.append(row.item)
        own.append(terms)
        size += len(terms)
    if names:
        yield names, own


def document_counts(index: DataFrame, hashes: np.ndarray) -> np.ndarray:
    """df of each of the sorted hashes, from the counts of all shards."""
    shared = index.sparkSession.sparkContext.broadcast(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        total = np.zeros(len(asked), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                terms = np.frombuffer(batch.column(0)[i].as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(asked, terms), len(asked) - 1)
                same = np.flatnonzero(asked[at] == terms)
                total[at[same]] += np.frombuffer(batch.column(1)[i].as_buffer(), np.int32)[same]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), pa.array(total[some])], names=["term", "df"])

    counted = index.select("terms", "counts").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(len(hashes), np.int64)
    for row in counted.collect():  # a row per term that was asked for, at most
        out[row.term] = row.df
    shared.unpersist()
    return out


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search(
    index: DataFrame, items: DataFrame, n_docs: int, k: int = 50, item: str = "item_id", text: str = "text", pass_terms: int = PASS_TERMS
) -> DataFrame:
    """(item, rank, doc, score): the k best documents of each item with a score above 0, fewer where there are no more.

    n_docs: N as the index was built with. Every shard is searched for every item; a task keeps what it has found best, so
    that later shards are cut off sooner, and hands over k rows per item. Equal scores rank by id, null ids last; rows that
    share an id are ranked each. Items that are equal in id and text count once, those of one id and several texts are
    ranked together, null texts and texts without a term find nothing. Empty tables give no rows.
    """
    spark, out = index.sparkSession, None
    kind = items.schema[item].dataType.simpleString()
    for names, own in passes(item_terms(items, item, text), pass_terms):
        hashes = np.unique(np.concatenate(own))
        weights = np.array([weight(n_docs, d) for d in document_counts(index, hashes).tolist()], np.int64)
        bounds = np.concatenate(([0], np.cumsum([len(x) for x in own])))
        shared = spark.sparkContext.broadcast(Asked(names, hashes, weights, bounds, np.searchsorted(hashes, np.concatenate(own))))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            asked = shared.value
            best = [Best(k) for _ in asked.names]
            for batch in batches:
                for i in range(batch.num_rows):
                    docs = batch.column(0)[i].values
                    buffers = [batch.column(c)[i].as_buffer() for c in (1, 3, 4)]
                    shard = Treap(docs.fill_null(0).to_numpy(), docs.is_null().to_numpy(zero_copy_only=False), buffers[0], batch.column(2)[i].as_py(), *buffers[1:])
                    rows = shard.rows(asked.hashes)
                    for j, found in enumerate(best):
                        terms = asked.terms[asked.bounds[j] : asked.bounds[j + 1]]
                        terms = terms[(rows[terms] >= 0) & (asked.weights[terms] > 0)]
                        if len(terms):
                            shard.search(rows[terms], asked.weights[terms], found)
            at = np.repeat(np.arange(len(best)), [len(b.score) for b in best])
            if len(at):
                ids = np.concatenate([b.doc for b in best])
                score = np.concatenate([b.score for b in best])
                gone = np.concatenate([b.missing for b in best])
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(ids, mask=gone), pa.array(score)], names=["at", "doc", "score"])

        found = index.select("docs", "terms", "height", "nodes", "maxima").mapInArrow(run, "at int, doc long, score long")
        named = spark.createDataFrame(list(enumerate(names)), f"at int, item {kind}")
        found = found.join(F.broadcast(named), "at").select("item", "doc", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], f"item {kind}, doc long, score long")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_last()))
    return out.withColumn("rank", place).where(F.col("rank") <= k).select("item", "rank", "doc", "score")


SQL = r"""
WITH d AS (SELECT doc_id, text, row_number() OVER () AS r FROM documents),
     t AS (SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
     p AS (SELECT r, doc_id, term, count(*) AS tf FROM t GROUP BY r, doc_id, term),
     l AS (SELECT r AS lr, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY r),
     s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM l),
     q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS qt FROM benchmark),
     w AS (SELECT term AS wt, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM p, s GROUP BY term, docs),
     c AS (SELECT item_id, r, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // total))))) AS BIGINT) AS score
           FROM q JOIN w ON wt = qt JOIN p ON term = qt JOIN l ON lr = r, s GROUP BY item_id, r, doc_id),
     k AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM c WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
"""
