"""Ranked search over K2-treaps against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from odd_texts import odd_texts

from tabweave.llm import ranked_search
from tabweave.llm.ranked_search import Best, Treap, treap, unfolded

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(rows, items, k):
    held = [(i, Counter(terms(t))) for i, t in rows if terms(t)]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(map(str, out))


def some_rows():
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(200)] + ["é", "日本", "a1b2"]
    rows = [(i, " ".join(rng.choice(vocabulary[: rng.choice([5, 50, 203])]) for _ in range(rng.randrange(60)))) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(None, rows[3][1]), (None, rows[4][1]), rows[5], rows[5], (7, "W1, w2; É")]
    return rows + [(2000 + i, t) for i, t in enumerate(odd_texts())]


@pytest.mark.parametrize(("shard_bytes", "k"), [(500, 5), (1 << 20, 50), (4000, 1)])
def test_ranks_against_all_scores(spark, shard_bytes, k):
    rows = some_rows()
    rng = random.Random(10)
    items = [(i, " ".join(rng.choice([f"w{rng.randrange(220)}", "é", "W3", "none"]) for _ in range(rng.randrange(1, 30)))) for i in range(20)]
    items += [(50, rows[3][1]), (50, rows[3][1]), (51, None), (52, ""), (53, "none such"), (54, "w1 W1 w1"), (None, "w2 w3")]
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, item string, rank int").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    counted = ranked_search.totals(docs)
    held = [terms(t) for _, t in rows]
    assert counted == (sum(bool(t) for t in held), sum(map(len, held)))
    index = ranked_search.write_index(ranked_search.build(docs, shard_bytes=shard_bytes))
    assert sum(len(r.docs) for r in index.select("docs").collect()) == len([t for _, t in rows if t is not None])
    got = ranked_search.search(index, asked, counted[0], k=k, pass_terms=30)
    assert sorted(str(tuple(r)) for r in got.collect()) == plain(rows, items, k)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search.totals(none) == (0, 0)
    index = ranked_search.build(none)
    assert ranked_search.search(index, items, 0).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (2, " "), (3, None)], "doc_id long, text string")
    index = ranked_search.build(docs)
    assert ranked_search.search(index, items.limit(0), 1).count() == 0
    assert [tuple(r)[:3] for r in ranked_search.search(index, items, 1).collect()] == [(1, 1, 1)]


def test_treap_holds_maxima_of_quadrants():
    rng = np.random.default_rng(1)
    for height in (1, 3, 5):
        side = 1 << height
        grid = np.where(rng.random((side, side)) < 0.2, rng.integers(1, 1000, (side, side)), 0)
        grid[0, 0] = 5
        row, column = np.nonzero(grid)
        nodes, kept = treap(row, column, grid[row, column], height)
        maxima = unfolded(nodes, kept, height)
        want = [[int(grid.max())]]
        for level in range(1, height + 1):
            half = side >> level
            cells = grid.reshape(1 << level, half, 1 << level, half).max(axis=(1, 3))
            # Morton order of the cells of a level.
            order = sorted(np.ndindex(cells.shape), key=lambda c: [((c[0] >> b & 1) << 1 | c[1] >> b & 1) for b in reversed(range(level))])
            want.append([int(cells[c]) for c in order if cells[c]])
        assert maxima.tolist() == sum(want, []) and len(nodes) == sum(map(len, want[:-1]))
        assert len(kept) == 1 + sum(map(len, want[1:])) - len(nodes)
        # Searching with every row as a term gives the sums of columns.
        best = Best(3)
        hashes = np.arange(side, dtype=np.uint64)
        found = Treap(np.arange(side), np.zeros(side, bool), hashes.tobytes(), height, nodes.tobytes(), kept.tobytes())
        weights = rng.integers(1, 9, side)
        found.search(found.rows(hashes), weights, best)
        sums = (grid * weights[:, None]).sum(axis=0)
        assert best.score.tolist() == sorted(sums[sums > 0].tolist(), reverse=True)[:3]
