"""Similarity join of word shingle sets by signature trees.

Two texts link when their shingle sets have a Jaccard similarity of at least `percent`. The steps:

1. Order. The shingles of one text of each set are counted exactly: sent by their leading bits, four bytes each, with the
   place of their text, and those found in several sets are sent back to the texts with a level of how often. Rare shingles
   come first, then by hash; any order that is the same for all texts keeps the result right, a good one keeps the groups
   small. A shingle of one set comes first of all and can tie it to nothing, so it goes no further.
2. Blocks. Two sets that link share one of their first n - ceil(percent * n) + 1 shingles. Those are sent with a
   fingerprint of their set; the sets that meet at a shingle are tied to one of them, and
   connected components of these ties are blocks: links never leave a block.
3. Trees. One copy of each set of a block is sent to it. A signature tree holds the OR of token bitmaps, the size range and
   the largest number of tokens beyond the bits for every node. Trees are traversed in pairs: a pair of nodes is left when
   its sizes or the largest overlap that the bitmaps allow rule a link out, or when links found already connect all that
   both hold. What remains is compared exactly.

A block too large for one task is settled against one of its sets first; what does not link to it is compared with the
whole block, cut into parts by size. Of equal sets one takes part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.llm.arrays import BASE, Texts, mix, runs, text_of, texts
from tabweave.llm.components import components
from tabweave.llm.repeats import LAST, Bitmap, as_requests, bitmap, keyed, pack, request, row_key, summed, unpack
from tabweave.session import written

SHINGLE, PERCENT = 5, 80
LEVELS = (2, 3, 5, 9, 17, 33, 64)
#: Bytes of text whose shingles are counted together; shingles that a task sends together.
COUNT_BYTES, SENT_TOKENS = 12 << 20, 1 << 19
#: Tokens of one block in one task; above, a block is cut. Tokens of blocks that share a task.
BLOCK_TOKENS, TASK_TOKENS = 4 << 20, 1 << 20
#: Ways in which sets that meet at a shingle of the last level are dealt.
SALTS = 32
LEAF = 16


@dataclass
class Sets:
    """Shingle sets of the texts of a chunk, each in ascending order of hashes."""

    tokens: np.ndarray
    bounds: np.ndarray
    prints: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)


def shingle_sets(t: Texts) -> Sets:
    """Distinct runs of `SHINGLE` lower-case words of each text; all its words as one if it has fewer."""
    t = t.lowered()
    words, bounds = t.words, t.word_bounds
    first, token = runs(words, bounds, SHINGLE)
    text = text_of(first, bounds)
    n = np.diff(bounds)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        own = mix(np.array([int(sum(int(w) * (i + 1) for i, w in enumerate(words[bounds[s] : bounds[s + 1]].tolist())) % (1 << 64)) for s in short], np.uint64) ^ BASE)
        token, text = np.concatenate((token, own + n[short].astype(np.uint64))), np.concatenate((text, short))
        by = np.argsort(text, kind="stable")
        token, text = token[by], text[by]
    at = np.searchsorted(text, np.arange(len(t) + 1))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        token[a:b].sort()
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (text[1:] != text[:-1])
    token, text = token[new], text[new]
    bounds = np.searchsorted(text, np.arange(len(t) + 1))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(token ^ BASE))))
    return Sets(token, bounds, mix(total[bounds[1:]] - total[bounds[:-1]]) ^ np.diff(bounds).astype(np.uint64))


def needed(x, y):
    """Least overlap of sets of these sizes that link: 100 * overlap >= PERCENT * union."""
    return -((-PERCENT * (x + y)) // (100 + PERCENT))


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Sets, np.ndarray]]:
    for batch in batches:
        doc = batch.column(0).to_numpy()
        for t in texts(batch.column(1)):
            yield shingle_sets(t), doc[t.first : t.first + len(t)]


def pieces(bucket: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions of each bucket that occurs, with the buckets."""
    by = np.argsort(bucket, kind="stable")
    parts = np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1)
    return np.array([bucket[p[0]] for p in parts], np.int64), parts


#: What a part knows of its texts.
TEXTS = np.dtype([("n", "u4"), ("print", "u8"), ("doc", "i8")])


def pack_places(text: np.ndarray, *values: np.ndarray) -> bytes:
    """Ascending places of texts, as steps of a byte if all fit into one, and values of fixed width for each."""
    step = np.diff(text, prepend=0)
    kind = np.dtype(np.uint8 if not len(step) or step.max() < 256 else np.uint32)
    return b"".join((bytes([kind.itemsize]), step.astype(kind).tobytes(), *[v.tobytes() for v in values]))


def unpack_places(cell: pa.Buffer, *kinds: type) -> list[np.ndarray]:
    data = memoryview(cell)
    kinds = [np.dtype(np.uint8 if data[0] == 1 else np.uint32), *map(np.dtype, kinds)]
    n, at, out = (data.nbytes - 1) // sum(k.itemsize for k in kinds), 1, []
    for k in kinds:
        out.append(np.frombuffer(data, k, n, at))
        at += n * k.itemsize
    out[0] = np.cumsum(out[0], dtype=np.int64)
    return out


def shared_shingles(source: DataFrame, wanted: Broadcast[Bitmap], size: int) -> tuple[DataFrame, int]:
    """(part, bucket, cell, about): shingles found in several of the sets asked for, back at the texts they came from.

    A part is some texts of one task, told by `about` (in one of its rows); a cell has places of texts, levels and the lower
    32 bits of shingles whose leading bits are the bucket. Also returned: the number of leading bits.
    """
    log = min(30, max(3, math.ceil(math.log2(max(1, size / COUNT_BYTES)))))

    def cells(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], part: int) -> pa.RecordBatch:
        about, text, token = (np.concatenate(v) for v in zip(*held))
        bucket, parts = pieces((token >> np.uint64(64 - log)).astype(np.int64))
        low = ((token >> np.uint64(32 - log)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        sent = pa.array([pack_places(text[p], low[p]) for p in parts], pa.binary())
        told = pa.array([about.tobytes(), *[None] * (len(parts) - 1)], pa.binary())
        return pa.RecordBatch.from_pydict({"part": np.full(len(parts), part), "bucket": bucket, "cell": sent, "about": told})

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        held, n_texts, n_tokens = [], 0, 0
        for sets, doc in chunks(batches):
            n = sets.sizes
            some = (n > 0) & wanted.value.has(request(sets.prints, doc))
            if not some.any():
                continue
            about = np.zeros(int(some.sum()), TEXTS)
            about["n"], about["print"], about["doc"] = n[some], sets.prints[some], doc[some]
            token = sets.tokens[np.repeat(some, n)]
            held.append((about, n_texts + np.repeat(np.arange(len(about)), n[some]), token))
            n_texts, n_tokens = n_texts + len(about), n_tokens + len(token)
            if n_tokens >= SENT_TOKENS:
                yield cells(held, part)
                part, held, n_texts, n_tokens = part + 1, [], 0, 0
        if held:
            yield cells(held, part)

    def mark(table: pa.Table) -> pa.Table:
        found = [unpack_places(c.as_buffer(), np.uint32) for c in table.column("cell")]
        _, at, n = np.unique(np.concatenate([low for _, low in found]), return_inverse=True, return_counts=True)
        n, bounds = n[at], np.concatenate(([0], np.cumsum([len(low) for _, low in found])))
        level = np.searchsorted(LEVELS, n, "right").astype(np.uint8)
        out = []
        for (text, low), a, b in zip(found, bounds[:-1].tolist(), bounds[1:].tolist()):
            some = n[a:b] > 1
            out.append(pack_places(text[some], level[a:b][some], low[some]))
        marked = table.set_column(table.column_names.index("cell"), "cell", pa.array(out, pa.binary()))
        used = [len(c) > 1 or a.is_valid for c, a in zip(out, table.column("about"))]
        return marked.filter(pa.array(used, pa.bool_()))

    columns = "part long, bucket long, cell binary, about binary"
    return source.mapInArrow(send, columns).groupBy("bucket").applyInArrow(mark, columns), log


def needed_share(n):
    """Least overlap with a set of n shingles, whatever the size of the other."""
    return -((-PERCENT * n) // 100)


def prefixes(n: np.ndarray, text: np.ndarray, level: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Which shared shingles are among the first of their set that a link must share one of, given the sizes of all sets."""
    by = np.lexsort((token, level, text))
    held = np.bincount(text, minlength=len(n))
    rank = np.arange(len(by)) - np.repeat(np.cumsum(held) - held, held)
    alone = n - held
    return by[rank + alone[text[by]] < (n - needed_share(n) + 1)[text[by]]]


def meetings(source: DataFrame, wanted: Broadcast[Bitmap], size: int) -> DataFrame:
    """Ties (a, b) of sets that share a prefix shingle, through one of them for each shingle; with the document of a."""
    spark = source.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / COUNT_BYTES))
    shared, log = shared_shingles(source, wanted, size)

    def send(table: pa.Table) -> pa.Table:
        about = np.concatenate([np.frombuffer(c.as_buffer(), TEXTS) for c in table.column("about") if c.is_valid])
        cells = [unpack_places(c.as_buffer(), np.uint8, np.uint32) for c in table.column("cell")]
        text, level, low = (np.concatenate(v) for v in zip(*cells))
        bucket = np.repeat(table.column("bucket").to_numpy().astype(np.uint64), [len(c[0]) for c in cells])
        token = (bucket << np.uint64(64 - log)) | (low.astype(np.uint64) << np.uint64(32 - log))
        first = prefixes(about["n"].astype(np.int64), text, level, token)
        if not len(first):
            return pa.table({"bucket": pa.array([], pa.int64()), "cell": pa.array([], pa.binary())})
        text, level, token = text[first], level[first].astype(np.int64), token[first]
        rows = summed({"anchor": token, "region": about["print"][text], "low": about["doc"][text], "high": level, "n": np.ones(len(token), np.int64)})
        salt = np.where(rows["high"] == len(LEVELS), rows["region"] % np.uint64(SALTS), np.uint64(0))
        to, parts = pieces(((mix(rows["anchor"]) + salt * BASE) % np.uint64(buckets)).astype(np.int64))
        packed = [pack({k: v[p] for k, v in rows.items()}) for p in parts]
        return pa.table({"bucket": to, "cell": pa.array(packed, pa.binary())})

    def tie(table: pa.Table) -> pa.Table:
        cells = [unpack(c.as_py()) for c in table.column("cell")]
        rows = summed({k: np.concatenate([c[k] for c in cells]) for k in cells[0]})
        token, own = rows["anchor"], rows["region"].view(np.int64)
        new = np.concatenate(([True], token[1:] != token[:-1]))
        at = np.flatnonzero(new)
        head = own[at][np.cumsum(new) - 1]
        salted = rows["high"] == len(LEVELS)
        keep = (~new) | salted
        pairs = {"a": own, "b": head, "low": rows["low"], "head_low": rows["low"][at][np.cumsum(new) - 1]}
        out = {k: v[keep] for k, v in pairs.items()}
        # Heads of a salted shingle are tied to each other later, by the shingle.
        return pa.table({**out, "token": pa.array(token.view(np.int64)[keep], mask=~(salted & new)[keep])})

    sent = shared.groupBy("part").applyInArrow(send, "bucket long, cell binary")
    tied = written(sent.groupBy("bucket").applyInArrow(tie, "a long, b long, low long, head_low long, token long"), "ties")
    heads = tied.where("token IS NOT NULL").select("token", "a", "low")
    least = heads.groupBy("token").agg(F.min(F.struct("a", "low")).alias("m"))
    across = heads.join(least, "token").select("a", F.col("m.a").alias("b"), "low", F.col("m.low").alias("head_low"))
    return tied.drop("token").unionByName(across).where("a <> b").distinct()


def set_contents(source: DataFrame, shared: Broadcast[Bitmap]) -> DataFrame:
    """(print, low, tokens) of the sets asked for, from the document that was named with each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sets, doc in chunks(batches):
            some = np.flatnonzero(shared.value.has(request(sets.prints, doc)) & (sets.sizes > 0))
            yield pa.RecordBatch.from_pydict(
                {
                    "print": sets.prints[some].view(np.int64),
                    "low": doc[some],
                    "tokens": pa.array([sets.tokens[sets.bounds[i] : sets.bounds[i + 1]].tobytes() for i in some], pa.binary()),
                }
            )

    return source.mapInArrow(run, "print long, low long, tokens binary")


class Joined:
    """Which sets links connect so far."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


class SignatureTree:
    """Sets in ascending order of size; a leaf holds LEAF of them, an upper node two nodes."""

    def __init__(self, sets: list[np.ndarray], members: list[int], bits: int):
        self.sets, self.bits = sets, bits
        self.members = sorted(members, key=lambda i: (len(sets[i]), int(sets[i][0]) if len(sets[i]) else 0, i))
        self.sizes = np.array([len(sets[i]) for i in self.members], np.int64)
        self.maps = np.stack([self._map(sets[i]) for i in self.members])
        self.extra = self.sizes - np.bitwise_count(self.maps).sum(axis=1, dtype=np.int64)
        #: (first, last member, children, bitmap, least and largest size, largest extra)
        self.nodes: list[tuple[int, int, tuple[int, ...], np.ndarray, int, int, int]] = []
        level = [self._node(a, min(a + LEAF, len(members)), ()) for a in range(0, len(members), LEAF)]
        while len(level) > 1:
            level = [self._node(self.nodes[p[0]][0], self.nodes[p[-1]][1], tuple(p)) for p in (level[i : i + 2] for i in range(0, len(level), 2))]
        self.top = level[0]

    def _map(self, tokens: np.ndarray) -> np.ndarray:
        at = (mix(tokens) >> np.uint64(64 - self.bits)).astype(np.int64)
        flags = np.zeros(1 << self.bits, np.uint8)
        flags[at] = 1
        return np.packbits(flags).view(np.uint64)

    def _node(self, a: int, b: int, children: tuple[int, ...]) -> int:
        parts = [self.nodes[c][3] for c in children] if children else self.maps[a:b]
        self.nodes.append((a, b, children, np.bitwise_or.reduce(parts), int(self.sizes[a]), int(self.sizes[b - 1]), int(self.extra[a:b].max())))
        return len(self.nodes) - 1


def may_link(x: tuple, y: tuple) -> bool:
    """Whether the sizes and bitmaps of two nodes allow a link between what they hold."""
    if 100 * min(x[5], y[5]) < PERCENT * max(x[4], y[4]):
        return False
    overlap = min(x[5], y[5], min(x[6], y[6]) + int(np.bitwise_count(x[3] & y[3]).sum()))
    return overlap >= needed(x[4], y[4])


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum())


def dual_traversal(one: SignatureTree, two: SignatureTree, joined: Joined) -> list[tuple[int, int]]:
    """Links between sets of two trees (or inside one, given twice) that connect what was not connected before."""
    found: list[tuple[int, int]] = []
    inside = one is two
    uniform: dict[tuple[int, int], bool] = {}

    def single(tree: SignatureTree, which: int, node: int) -> int:
        """The root of all members if links connect them, else -1."""
        a, b, children = tree.nodes[node][:3]
        first = joined.root(tree.members[a])
        if uniform.get((which, node)):
            return first
        if children:
            same = all(single(tree, which, c) == first for c in children)
        else:
            same = all(joined.root(m) == first for m in tree.members[a:b])
        if same:
            uniform[(which, node)] = True
        return first if same else -1

    todo = [(one.top, two.top)]
    while todo:
        i, j = todo.pop()
        x, y = one.nodes[i], two.nodes[j]
        if not may_link(x, y):
            continue
        root = single(one, 0, i)
        if root >= 0 and (inside and i == j or root == single(two, 0 if inside else 1, j)):
            continue
        if not x[2] and not y[2]:
            common = np.bitwise_count(one.maps[x[0] : x[1], None] & two.maps[None, y[0] : y[1]]).sum(axis=2, dtype=np.int64)
            n, m = one.sizes[x[0] : x[1], None], two.sizes[None, y[0] : y[1]]
            most = np.minimum(one.extra[x[0] : x[1], None], two.extra[None, y[0] : y[1]]) + common
            for p, q in zip(*np.nonzero(np.minimum(most, np.minimum(n, m)) >= needed(n, m))):
                s, t = one.members[x[0] + p], two.members[y[0] + q]
                if s != t and joined.root(s) != joined.root(t) and overlap(one.sets[s], two.sets[t]) >= needed(len(one.sets[s]), len(two.sets[t])):
                    joined.join(s, t)
                    found.append((s, t))
        elif inside and i == j:
            children = x[2]
            todo += [(a, b) for k, a in enumerate(children) for b in children[k + 1 :]] + [(a, a) for a in children]
        elif not y[2] or x[2] and x[1] - x[0] >= y[1] - y[0]:
            todo += [(c, j) for c in x[2]]
        else:
            todo += [(i, c) for c in y[2]]
    return found


def tree_bits(sets: list[np.ndarray]) -> int:
    """Width of bitmaps: four bits for each token of the largest set, within bounds."""
    return min(16, max(6, math.ceil(math.log2(4 * max(1, max(map(len, sets)))))))


def links_inside(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    tree = SignatureTree(sets, list(range(len(sets))), tree_bits(sets))
    return dual_traversal(tree, tree, Joined(len(sets)))


def links_between(sets: list[np.ndarray], one: list[int], two: list[int]) -> list[tuple[int, int]]:
    bits = tree_bits(sets)
    return dual_traversal(SignatureTree(sets, one, bits), SignatureTree(sets, two, bits), Joined(len(sets)))


def _unique(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Prints, sets and rows of a table with each print once."""
    names, at = np.unique(table.column("print").to_numpy(), return_index=True)
    cells = table.column("tokens").combine_chunks().take(pa.array(at))
    return names, [np.frombuffer(c.as_py(), np.uint64) for c in cells], at


def solve_blocks(table: pa.Table) -> pa.Table:
    """Links of whole blocks."""
    names, sets, at = _unique(table)
    block = table.column("block").to_numpy()[at]
    by = np.argsort(block, kind="stable")
    out = []
    for part in np.split(by, np.flatnonzero(np.diff(block[by])) + 1):
        if len(part) > 1:
            out += [(names[part[i]], names[part[j]]) for i, j in links_inside([sets[k] for k in part])]
    a, b = np.array(out, np.int64).reshape(-1, 2).T
    return pa.table({"a": a, "b": b})


def solve_parts(table: pa.Table) -> pa.Table:
    """Links between the open sets of one part of a block and all sets of another part."""
    names, sets, at = _unique(table)
    side = {}
    for name, s in zip(table.column("print").to_pylist(), table.column("open").to_pylist()):
        side.setdefault(name, set()).add(s)
    one = [i for i, n in enumerate(names.tolist()) if True in side[n]]
    two = [i for i, n in enumerate(names.tolist()) if False in side[n]]
    out = [(names[i], names[j]) for i, j in links_between(sets, one, two)] if one and two else []
    a, b = np.array(out, np.int64).reshape(-1, 2).T
    return pa.table({"a": a, "b": b})


def large_block_links(sent: DataFrame) -> DataFrame:
    """Links of blocks too large for a task: to one set of each block, then of what is left to the parts of the block."""
    pivot = sent.groupBy("block").agg(F.min(F.struct("print", "tokens")).alias("p")).select("block", F.col("p.print").alias("pivot"), F.col("p.tokens").alias("pivot_tokens"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = ([np.frombuffer(c.as_py(), np.uint64) for c in batch.column(k)] for k in ("tokens", "pivot_tokens"))
            linked = [overlap(s, t) >= needed(len(s), len(t)) for s, t in zip(x, y)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in ("block", "print", "tokens", "n", "pivot")], pa.array(linked, pa.bool_())], names=["block", "print", "tokens", "n", "pivot", "linked"])

    compared = written(sent.join(pivot, "block").mapInArrow(compare, "block long, print long, tokens binary, n long, pivot long, linked boolean"), "compared")
    straight = compared.where("linked AND print <> pivot").select(F.col("print").alias("a"), F.col("pivot").alias("b"))
    parts = compared.groupBy("block").agg(F.sum("n").alias("total")).select("block", F.ceil(F.col("total") / (BLOCK_TOKENS // 2)).alias("parts"))
    dealt = compared.join(parts, "block").withColumn("part", F.pmod(F.col("print"), F.col("parts")))
    left = dealt.where("NOT linked").select("block", "print", "tokens", F.lit(True).alias("open"), F.col("part").alias("i"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("j"))
    used = left.select("block", "i").distinct()
    right = dealt.select("block", "print", "tokens", F.lit(False).alias("open"), F.col("part").alias("j")).join(used, "block")
    both = left.unionByName(right.select(*left.columns))
    return straight.unionByName(both.groupBy("block", "i", "j").applyInArrow(solve_parts, "a long, b long"))


def blocks(spark: SparkSession, source: DataFrame, ties: DataFrame) -> DataFrame:
    """Links (a, b) between sets, enough to connect all that links connect."""
    low = ties.select("a", "low").unionByName(ties.select(F.col("b").alias("a"), F.col("head_low").alias("low"))).groupBy("a").agg(F.min("low").alias("low"))
    members = written(components(ties).join(low, F.col("node") == F.col("a")).select(F.col("node").alias("region"), F.col("root").alias("block"), "low"), "blocks")
    wanted = spark.sparkContext.broadcast(bitmap(as_requests(members), members.count()))
    sent = set_contents(source, wanted).join(members.select(F.col("region").alias("print"), "block", F.col("low").alias("from")), "print")
    sent = written(sent.where("low = from").select("block", "print", "tokens", (F.octet_length("tokens") / 8).cast("bigint").alias("n")).dropDuplicates(["print"]), "sets")
    wanted.destroy()
    sizes = sent.groupBy("block").agg(F.sum("n").alias("total"))
    total = sizes.agg(F.sum("total")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / TASK_TOKENS))
    with_size = sent.join(sizes, "block")
    small = with_size.where(F.col("total") <= BLOCK_TOKENS).withColumn("task", F.pmod(F.xxhash64("block"), F.lit(tasks)))
    links = small.groupBy("task").applyInArrow(solve_blocks, "a long, b long")
    return links.unionByName(large_block_links(with_size.where(F.col("total") > BLOCK_TOKENS).drop("total")))


def near_copies(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, key, n_shingles, component_id, first) of every row: size of its set, smallest id that links reach, its own included.

    key: `repeats.row_key` of the row. first: whether the row has the smallest (id, key) of its component. A null, empty or
    blank text has an empty set, links with nothing and is first; equal sets link. A null id is larger than all others and
    shown only where no other is reached. Repeated rows are rows with equal results. Other columns are not read.
    """
    spark = docs.sparkSession
    source = keyed(docs, doc, text).select("doc", "text", "key")
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for sets, id_ in chunks(iter([batch])):
                key = batch.column(2).slice(done, len(id_))
                done += len(id_)
                columns = [pa.array(id_), key, pa.array(sets.sizes.astype(np.int64)), pa.array(sets.prints.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "key", "n_shingles", "print"])

    rows = written(source.mapInArrow(describe, "doc long, key long, n_shingles long, print long"), "rows")
    plain = source.select("doc", "text")
    least = written(rows.where("n_shingles > 0").groupBy("print").agg(F.min(F.struct("doc", "key")).alias("least")), "least")
    ones = least.select(F.col("print").alias("region"), F.col("least.doc").alias("low"))
    wanted = spark.sparkContext.broadcast(bitmap(as_requests(ones), least.count()))
    ties = written(meetings(plain, wanted, size), "meetings")
    wanted.destroy()
    roots = components(blocks(spark, plain, ties))
    least = least.join(roots, F.col("print") == F.col("node"), "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    of_root = least.groupBy("root").agg(F.min("least").alias("lead"))
    named = least.join(of_root, "root").select("print", "lead")
    joined = rows.join(named, "print", "left").withColumn("alone", F.col("n_shingles") == 0)
    component = F.when(F.col("alone"), F.col("doc")).otherwise(F.col("lead.doc"))
    return joined.select(
        F.nullif("doc", F.lit(LAST)).alias("id"),
        "key",
        "n_shingles",
        F.nullif(component, F.lit(LAST)).alias("component_id"),
        (F.col("alone") | (F.col("lead") == F.struct("doc", "key"))).alias("first"),
    )


def keep_first(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, the one with the smallest id, with all its columns unchanged; of repeated rows one."""
    found = near_copies(docs, doc, text)
    kept = found.where("first").select(F.col("key").alias("_key")).distinct()
    # The row travels as one value, so that no name of its columns can clash.
    rows = docs.select(row_key(docs, doc, text).alias("_key"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    one = rows.join(kept, "_key", "left_semi").dropDuplicates(["_key"])
    return one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
