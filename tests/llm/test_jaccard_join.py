import random

import numpy as np

from tabweave.llm import jaccard_join
from tabweave.llm.components import components
from tabweave.session import written

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = (text or "").encode().translate(LOWER).split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def plain(rows):
    """(id, set size, smallest id of the component, any name of it) of each row, from all pairs."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    ids = [float("inf") if d is None else d for d, _ in rows]
    least = {}
    for i in range(len(rows)):
        least[root(i)] = min(ids[i], least.get(root(i), float("inf")))
    return [(d, len(s), None if least[root(i)] == float("inf") else least[root(i)], root(i)) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def result(df):
    return sorted(map(str, (tuple(r) for r in df.select("id", "n_shingles", "component_id").collect())))


def test_against_all_pairs(odd, odd_rows):
    assert result(jaccard_join.near_copies(odd)) == sorted(str(p[:3]) for p in plain([r[:2] for r in odd_rows]))


def test_one_row_of_each_component_stays(odd, odd_rows):
    got = sorted(str(r.doc_id) for r in jaccard_join.keep_first(odd).collect())
    found = plain([r[:2] for r in odd_rows])
    empty = {(d, t) for (d, n, _, _), (_, t) in zip(found, [r[:2] for r in odd_rows]) if not n}
    assert got == sorted([str(c) for c, _ in {(c, name) for _, n, c, name in found if n}] + [str(d) for d, _ in empty])
    assert jaccard_join.keep_first(odd).columns == odd.columns


def test_no_rows(no_docs):
    assert jaccard_join.near_copies(no_docs).count() == 0 and jaccard_join.keep_first(no_docs).count() == 0


def family(rng, n, size, edits):
    """Texts with some words of a common base changed, similarities on both sides of the bound."""
    base = [f"b{rng.randrange(10**6)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(size)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_cut_blocks_and_salted_shingles_give_the_same(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, t) for i, t in enumerate(family(rng, 90, 60, 4) + family(rng, 30, 40, 3) + family(rng, 30, 200, 8))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(str(p[:3]) for p in plain(rows))
    assert result(jaccard_join.near_copies(df)) == want
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", 600)
    monkeypatch.setattr(jaccard_join, "LEVELS", (2, 3, 4))
    assert result(jaccard_join.near_copies(df)) == want


def test_traversal_against_all_pairs():
    rng = random.Random(4)
    for _ in range(20):
        sets = []
        for t in family(rng, rng.randrange(1, 60), 40, 5) + family(rng, rng.randrange(1, 20), 60, 30):
            sets.append(np.sort(np.array([hash(s) % (1 << 62) for s in shingles(t)], np.uint64)))
        want = {(i, j) for i in range(len(sets)) for j in range(i) if jaccard_join.overlap(sets[i], sets[j]) >= jaccard_join.needed(len(sets[i]), len(sets[j]))}

        def classes(pairs):
            joined = jaccard_join.Joined(len(sets))
            for i, j in pairs:
                joined.join(i, j)
            return [joined.root(i) for i in range(len(sets))]

        found = jaccard_join.links_inside(sets)
        assert classes(found) == classes(want) and {tuple(sorted(p, reverse=True)) for p in found} <= want
        half = len(sets) // 2
        one, two = list(range(half)), list(range(half, len(sets)))
        if one and two:
            across = jaccard_join.links_between(sets, one, two)
            assert classes(across + [p for p in want if (p[0] < half) == (p[1] < half)]) == classes(want)


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (1299, 5000), (None, 3)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {got[i] for i in range(61)} == {0} and {got[1000 + i] for i in range(300)} == {1000} and got[5000] == 1000
    assert len(got) == 61 + 300 + 1
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingles_of_one_set_come_first_however_many_there_are(spark, monkeypatch):
    rng = random.Random(6)

    def words(n):
        return [f"w{rng.randrange(10**9)}" for _ in range(n)]

    rows = []
    for i in range(0, 60, 2):
        phrase = words(30)
        rows += [(i + k, " ".join(words(170) + phrase)) for k in range(2)]
    base = words(200)
    rows += [(100, " ".join(base)), (101, " ".join([*base[:-1], "changed"]))]
    seen = {}

    def spy(df, name):
        seen[name] = written(df, name)
        return seen[name]

    monkeypatch.setattr(jaccard_join, "written", spy)
    # Bitmaps of the shingles in several texts, if there are any, as full as they get on a long table.
    monkeypatch.setattr(jaccard_join, "MOST_BITS", 6, raising=False)
    got = result(jaccard_join.near_copies(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == sorted(str(p[:3]) for p in plain(rows))
    # Only the near copies meet; a phrase of two texts ties neither, as each has enough shingles of its own.
    assert seen["meetings"].count() == 1 and seen["sets"].count() == 2
