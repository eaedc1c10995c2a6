"""Passages of a fixed length that occur in more than one place: what the two substring operators share.

Every window of `window` units (words or bytes) has least-hashed grams of `gram` units inside it, its anchors, and equal
windows have the same anchors. So windows can only be equal if they meet at an anchor. The steps:

1. Survey. Each anchor is sent with a hash of its region (all windows around it), equal ones summed up beforehand by
   chunk, packed into one binary cell per chunk and bucket. A group of one anchor shows which regions are found in several
   places; where regions differ, only parts of them may be.
2. Contents. One copy of each differing region is sent to the bucket of its anchor, where the operator's own method
   decides which windows are equal. Regions of an anchor that has too many for one task are dealt by window instead.
3. Verdicts go back to the places of the regions by a join, and from there to the documents as spans.

Anchors that matter are picked on the second and third reading of the documents with a bitmap of bounded size; a full
bitmap lets more rows through and changes no result. Regions found a million times are one row per chunk, and joined by
plain rows, which Spark splits when they are skewed. Tables between the steps are written to the shared folder.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabweave.llm.arrays import BASE, BYTE_VALUES, Texts, minimizers, mix, runs, span_hash, sums, text_of, texts
from tabweave.session import written

LAST = (1 << 63) - 1
#: Bytes of text for one bucket of the survey; bytes of contents for one bucket of the second step.
SURVEY_BYTES, CONTENT_BYTES = 6 << 20, 3 << 20
#: Differing regions of one anchor that go to one task; of more, every window is compared by its hash.
TASK_REGIONS = 20_000
#: A bitmap has 16 bits for each value, within these powers of two.
LEAST_BITS, MOST_BITS, SEGMENT_BITS = 16, 28, 16


@dataclass(frozen=True)
class Grain:
    """What a window is made of.

    units: hashed units of the texts and where each text ends. raw: the same units as they are sent. earlier_only: only
    places in documents with a smaller id count, else any other place. solve: from the differing regions of a bucket
    (`Regions`) the rows (region, first offset, last offset, smallest document) of windows found elsewhere.
    """

    window: int
    gram: int
    units: Callable[[Texts], tuple[np.ndarray, np.ndarray]]
    raw: Callable[[Texts], np.ndarray]
    earlier_only: bool
    solve: Callable[[Regions], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


@dataclass
class Anchors:
    """Places of the anchors of a chunk: position, start and end of the region in units; hashes of gram and region."""

    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    region: np.ndarray
    text: np.ndarray

    def only(self, some: np.ndarray) -> Anchors:
        return Anchors(*[v[some] for v in (self.at, self.first, self.last, self.anchor, self.region, self.text)])


@dataclass
class Regions:
    """Differing regions of some anchors: contents joined, content i is `data[bounds[i]:bounds[i + 1]]`.

    left: units before the anchor. doc: smallest document with the region.
    """

    anchor: np.ndarray
    region: np.ndarray
    doc: np.ndarray
    left: np.ndarray
    data: np.ndarray
    bounds: np.ndarray


def anchors(t: Texts, grain: Grain) -> Anchors:
    """Anchors of the texts that hold a whole window."""
    values, bounds = grain.units(t)
    first, grams = runs(values, bounds, grain.gram)
    chosen = minimizers(grams, grain.window - grain.gram + 1)
    at, anchor = first[chosen], grams[chosen]
    text = text_of(at, bounds)
    start = np.maximum(bounds[text], at - (grain.window - grain.gram))
    end = np.minimum(bounds[text + 1], at + grain.window)
    whole = np.flatnonzero(end - start >= grain.window)
    found = Anchors(at, start, end, anchor, anchor, text).only(whole)
    if len(whole):
        found.region = mix(span_hash(sums(values), found.first, found.last) + (found.at - found.first).astype(np.uint64) * BASE)
    return found


def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Texts, np.ndarray, np.ndarray]]:
    """Chunks of (key, document, text) batches with the key and document of each text."""
    for batch in batches:
        key, doc = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for t in texts(batch.column(2)):
            yield t, key[t.first : t.first + len(t)], doc[t.first : t.first + len(t)]


def keyed(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(key of the row, document or the largest id for null, text or empty for null)."""
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    return docs.select(row_key(docs, doc, text).alias("key"), F.coalesce(docs[doc].cast("bigint"), F.lit(LAST)).alias("doc"), body.alias("text"))


def row_key(docs: DataFrame, doc: str, text: str) -> Column:
    return F.xxhash64(docs[doc].cast("bigint"), F.coalesce(docs[text].cast("string"), F.lit("")))


SURVEY = np.dtype([("anchor", "u8"), ("region", "u8"), ("low", "i8"), ("high", "i8"), ("n", "u4")])


def pack(rows: dict[str, np.ndarray]) -> bytes:
    """Columns one after the other, so that the shuffle's compression sees like values together."""
    return b"".join(np.ascontiguousarray(rows[f], SURVEY[f]).tobytes() for f in SURVEY.names)


def unpack(cell: bytes | pa.Buffer) -> dict[str, np.ndarray]:
    cell = memoryview(cell)
    n, at, out = cell.nbytes // SURVEY.itemsize, 0, {}
    for f in SURVEY.names:
        out[f] = np.frombuffer(cell, SURVEY[f], n, at)
        at += n * SURVEY[f].itemsize
    return out


def summed(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """One row per anchor and region, in this order."""
    by = np.lexsort((rows["region"], rows["anchor"]))
    rows = {k: v[by] for k, v in rows.items()}
    new = np.ones(len(by), bool)
    new[1:] = (rows["anchor"][1:] != rows["anchor"][:-1]) | (rows["region"][1:] != rows["region"][:-1])
    at = np.flatnonzero(new)
    return {
        "anchor": rows["anchor"][at],
        "region": rows["region"][at],
        "low": np.minimum.reduceat(rows["low"], at),
        "high": np.maximum.reduceat(rows["high"], at),
        "n": np.minimum(np.add.reduceat(rows["n"].astype(np.int64), at), 1 << 30),
    }


def survey(source: DataFrame, grain: Grain) -> DataFrame:
    """Regions of the anchors that are found in more than one place: (anchor, region, low, again, differs).

    again: the region itself is found elsewhere (for documents with an id above `low`, if only those count). differs: its
    anchor has other regions too.
    """
    spark = source.sparkSession
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / SURVEY_BYTES))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, _, doc in frames(batches):
            found = anchors(t, grain)
            if not len(found.at):
                continue
            low = doc[found.text]
            rows = summed({"anchor": found.anchor, "region": found.region, "low": low, "high": low, "n": np.ones(len(low), np.int64)})
            bucket = rows["anchor"] % np.uint64(buckets)
            by = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.diff(bucket[by])) + 1
            parts = np.split(by, cut)
            cells = [pack({k: v[p] for k, v in rows.items()}) for p in parts]
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([int(bucket[p[0]]) for p in parts], pa.int64()), "cell": pa.array(cells, pa.binary())})

    def gather(table: pa.Table) -> pa.Table:
        cells = [unpack(c.as_buffer()) for c in table.column("cell")]
        rows = summed({k: np.concatenate([c.pop(k) for c in cells]) for k in SURVEY.names})
        new = np.ones(len(rows["anchor"]), bool)
        new[1:] = rows["anchor"][1:] != rows["anchor"][:-1]
        at = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        many = np.diff(np.append(at, len(new))) > 1
        if grain.earlier_only:
            found = np.minimum.reduceat(rows["low"], at) < np.maximum.reduceat(rows["high"], at)
            again = rows["low"] < rows["high"]
        else:
            found = np.add.reduceat(rows["n"], at) > 1
            again = rows["n"] > 1
        keep = found[group]
        out = {"anchor": rows["anchor"].view(np.int64), "region": rows["region"].view(np.int64), "low": rows["low"], "again": again, "differs": many[group]}
        return pa.table({k: v[keep] for k, v in out.items()})

    sent = source.mapInArrow(send, "bucket long, cell binary")
    return sent.groupBy("bucket").applyInArrow(gather, "anchor long, region long, low long, again boolean, differs boolean")


@dataclass
class Bitmap:
    """A set of 64-bit values of bounded size that may hold some more."""

    bits: int
    data: np.ndarray

    def has(self, values: np.ndarray) -> np.ndarray:
        at = mix(values) >> np.uint64(64 - self.bits)
        return (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap(values: DataFrame, n: int) -> Bitmap:
    """The bitmap of a bigint column; at most 2**MOST_BITS bits, which is what a broadcast of it may cost."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(16 * max(1, n)))))
    width = min(bits, SEGMENT_BITS)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = mix(batch.column(0).to_numpy().view(np.uint64)) >> np.uint64(64 - bits)
            yield pa.RecordBatch.from_pydict({"part": (at >> np.uint64(width)).astype(np.int64), "bit": (at & np.uint64((1 << width) - 1)).astype(np.int32)})

    def fill(table: pa.Table) -> pa.Table:
        flags = np.zeros(1 << width, np.uint8)
        flags[table.column("bit").to_numpy()] = 1
        return pa.table({"part": table.column("part").slice(0, 1), "cell": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

    data = np.zeros(1 << (bits - 3), np.uint8)
    parts = values.mapInArrow(send, "part long, bit int").groupBy("part").applyInArrow(fill, "part long, cell binary")
    for row in parts.toLocalIterator():
        data[row.part << (width - 3) : (row.part + 1) << (width - 3)] = np.frombuffer(row.cell, np.uint8)
    return Bitmap(bits, data)


def request(region: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return mix(region ^ mix(doc.astype(np.int64).view(np.uint64)))


def as_requests(found: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            region, doc = (batch.column(i).to_numpy() for i in (0, 1))
            yield pa.RecordBatch.from_pydict({"value": request(region.view(np.uint64), doc).view(np.int64)})

    return found.select("region", "low").mapInArrow(run, "value long")


def contents(source: DataFrame, grain: Grain, shared: Broadcast[tuple[Bitmap, Bitmap]]) -> DataFrame:
    """(anchor, region, doc, left, content, crowded) of the regions asked for, from the document that was named with each.

    shared: bitmaps of the regions asked for and of the crowded anchors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, _, doc in frames(batches):
            found = anchors(t, grain)
            low = doc[found.text]
            wanted, crowded = shared.value
            some = np.flatnonzero(wanted.has(request(found.region, low)))
            if len(some):
                found, low, raw = found.only(some), low[some], grain.raw(t)
                yield pa.RecordBatch.from_pydict(
                    {
                        "anchor": found.anchor.view(np.int64),
                        "region": found.region.view(np.int64),
                        "doc": low,
                        "left": (found.at - found.first).astype(np.int32),
                        "content": pa.array([raw[a:b].tobytes() for a, b in zip(found.first, found.last)], pa.binary()),
                        "crowded": crowded.has(found.anchor),
                    }
                )

    return source.mapInArrow(run, "anchor long, region long, doc long, left int, content binary, crowded boolean")


def joined(cells: pa.Array, grain: Grain) -> tuple[np.ndarray, np.ndarray]:
    """Units of some contents one after the other, without a copy, and where each begins and ends."""
    kind = grain.raw(Texts(0, np.zeros(0, np.uint8), np.zeros(1, np.int64))).dtype
    _, offsets, data = cells.buffers()
    at = np.frombuffer(offsets, np.int32)[cells.offset : cells.offset + len(cells) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if len(cells) and data is not None else np.zeros(0, np.uint8)
    return data.view(kind), (at - at[0]) // kind.itemsize


def solved(sent: DataFrame, grain: Grain, buckets: int) -> DataFrame:
    """(region, first, last, low) of the windows of differing regions that are found elsewhere."""

    def run(table: pa.Table) -> pa.Table:
        anchor, region, doc, left = (table.column(k).to_numpy() for k in ("anchor", "region", "doc", "left"))
        by = np.lexsort((doc, region, anchor))
        new = np.ones(len(by), bool)
        new[1:] = region[by][1:] != region[by][:-1]
        by = by[new]
        data, bounds = joined(table.column("content").combine_chunks().take(pa.array(by)), grain)
        regions = Regions(anchor[by], region[by], doc[by], left[by].astype(np.int64), data, bounds)
        index, first, last, low = grain.solve(regions)
        return pa.table({"region": regions.region[index], "first": first.astype(np.int32), "last": last.astype(np.int32), "low": low})

    dealt = sent.withColumn("bucket", F.pmod(F.col("anchor"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(run, "region long, first int, last int, low long")


def by_window(sent: DataFrame, grain: Grain) -> DataFrame:
    """What `solved` returns, for anchors with more regions than a task should hold: equal windows meet by their hash.

    Windows are summed up before they are shuffled, so a window of all regions is one row per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, region, doc, left = (batch.column(i).to_numpy() for i in range(4))
            data, bounds = joined(batch.column(4), grain)
            first, window = runs(BYTE_VALUES[data] if data.dtype == np.uint8 else data, bounds, grain.window)
            of = text_of(first, bounds)
            offset = left[of] - (first - bounds[of])
            some = np.flatnonzero((offset >= 0) & (offset <= grain.window - grain.gram))
            of, offset, window = of[some], offset[some], window[some]
            name = mix(window + offset.astype(np.uint64) * BASE) ^ anchor[of].view(np.uint64)
            yield pa.RecordBatch.from_pydict({"window": mix(name).view(np.int64), "region": region[of], "offset": offset.astype(np.int32), "doc": doc[of]})

    rows = sent.select("anchor", "region", "doc", "left", "content").mapInArrow(run, "window long, region long, offset int, doc long")
    rows = written(rows.groupBy("window", "region", "offset").agg(F.min("doc").alias("doc")), "windows")
    equal = rows.groupBy("window").agg(F.min("doc").alias("low"), F.count("*").alias("n")).where("n > 1")
    found = rows.join(equal, "window")
    found = found.where("low < doc") if grain.earlier_only else found.withColumn("low", F.lit(-1).cast("bigint"))
    order = W.partitionBy("region", "low").orderBy("offset")
    lined = found.withColumn("line", F.col("offset") - F.row_number().over(order))
    return lined.groupBy("region", "low", "line").agg(F.min("offset").alias("first"), F.max("offset").alias("last")).select("region", "first", "last", "low")


def places(source: DataFrame, grain: Grain, wanted: Bitmap) -> DataFrame:
    """(key, doc, region, at, left, right) of every place of the regions in the bitmap."""
    shared = source.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, key, doc in frames(batches):
            found = anchors(t, grain)
            found = found.only(np.flatnonzero(shared.value.has(found.region)))
            start = grain.units(t)[1][found.text]
            yield pa.RecordBatch.from_pydict(
                {
                    "key": key[found.text],
                    "doc": doc[found.text],
                    "region": found.region.view(np.int64),
                    "at": (found.at - start).astype(np.int32),
                    "left": (found.at - found.first).astype(np.int32),
                    "right": (found.last - found.at).astype(np.int32),
                }
            )

    return source.mapInArrow(run, "key long, doc long, region long, at int, left int, right int")


def spans(docs: DataFrame, grain: Grain, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans) for every row of `docs` with repeated windows: `spans` are [first, last) in units, in no order.

    The key is that of `keyed`; rows that agree in document and text have one key and one result.
    """
    source = keyed(docs, doc, text)
    found = written(survey(source, grain), "survey")
    differing = found.where("differs")
    n = differing.count()
    crowded = differing.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > TASK_REGIONS).select("anchor")
    n_crowded = crowded.count()
    wanted = docs.sparkSession.sparkContext.broadcast((bitmap(as_requests(differing), n), bitmap(crowded, n_crowded)))
    width = grain.window * (2 if grain.earlier_only else 1) * 10
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n * width / CONTENT_BYTES))
    sent = contents(source, grain, wanted)
    if n_crowded:
        sent = written(sent, "contents")
        parts = solved(sent.where("NOT crowded"), grain, buckets).unionByName(by_window(sent.where("crowded"), grain))
    else:
        parts = solved(sent, grain, buckets)
    whole = found.where("again").select("region", F.lit(0).alias("first"), F.lit(grain.window - grain.gram).alias("last"), "low")
    verdicts = written(whole.unionByName(parts), "verdicts")
    wanted.destroy()
    asked = verdicts.select("region")
    at = places(source, grain, bitmap(asked, asked.count()))
    found = at.join(verdicts, "region")
    if grain.earlier_only:
        found = found.where("low < doc")
    span = F.struct(
        F.greatest(F.col("at") - F.col("left"), F.col("at") - F.col("last")).alias("first"),
        F.least(F.col("at") + F.col("right"), F.col("at") - F.col("first") + grain.window).alias("last"),
    )
    # A set: rows that agree in document and text name the same spans, however many they are.
    return found.groupBy("key").agg(F.collect_set(span).alias("spans"))


def applied(docs: DataFrame, found: DataFrame, doc: str, text: str, run: Callable, schema: str) -> DataFrame:
    """Every row of `docs` (id, text as in `docs`, spans or null) through `run`."""
    rows = docs.select(docs[doc].alias("id"), docs[text].cast("string").alias("text"), row_key(docs, doc, text).alias("key"))
    joined = rows.join(found, "key", "left").select("id", "text", F.col("spans.first").alias("first"), F.col("spans.last").alias("last"))
    return joined.mapInArrow(run, schema)

