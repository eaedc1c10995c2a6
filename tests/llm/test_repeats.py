import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tabweave.llm import repeats, substring_dedup, suffix_dedup
from tabweave.llm.repeats import Regions

LAST = 1 << 63


def plain_words(rows, n=13):
    first = {}
    for id_, text in rows:
        w = (text or "").encode().split()
        for i in range(len(w) - n + 1):
            k = tuple(w[i : i + n])
            first[k] = min(LAST if id_ is None else id_, first.get(k, LAST))
    out = []
    for id_, text in rows:
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < (LAST if id_ is None else id_):
                gone[i : i + n] = [True] * n
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((id_, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def plain_bytes(rows, n=400):
    count = Counter()
    for _, text in rows:
        b = (text or "").encode()
        count.update(b[i : i + n] for i in range(len(b) - n + 1))
    out = []
    for id_, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - n + 1):
            if count[b[i : i + n]] > 1:
                gone[i : i + n] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
        out.append((id_, len(b), int(gone[:-1].sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def key(row):
    return tuple((v is None, v) for v in row)


def test_words_against_all_windows(odd, odd_rows):
    got = [tuple(r) for r in substring_dedup.dedup(odd).drop("kept").collect()]
    assert sorted(got, key=key) == sorted(plain_words([r[:2] for r in odd_rows]), key=key)


def test_bytes_against_all_windows(odd, odd_rows):
    rows = [r for r in odd_rows if r[1] is None or len(r[1]) < 50_000]
    got = [tuple(r) for r in suffix_dedup.dedup(odd.where("text IS NULL OR length(text) < 50000")).drop("kept").collect()]
    assert sorted(got, key=key) == sorted(plain_bytes([r[:2] for r in rows]), key=key)


@pytest.mark.parametrize("most", [0, 2])
def test_crowded_anchors_give_the_same(odd, odd_rows, monkeypatch, most):
    monkeypatch.setattr(repeats, "TASK_REGIONS", most)
    small, rows = odd.where("text IS NULL OR length(text) < 50000"), [r[:2] for r in odd_rows if r[1] is None or len(r[1]) < 50_000]
    got = [tuple(r) for r in substring_dedup.dedup(small).drop("kept").collect()]
    assert sorted(got, key=key) == sorted(plain_words(rows), key=key)
    got = [tuple(r) for r in suffix_dedup.dedup(small).drop("kept").collect()]
    assert sorted(got, key=key) == sorted(plain_bytes(rows), key=key)


@pytest.mark.parametrize("module", [substring_dedup, suffix_dedup])
def test_no_rows(no_docs, module):
    assert module.dedup(no_docs).count() == 0


def test_kept_bytes_and_removed_spans_make_the_text(odd):
    for r in suffix_dedup.dedup(odd).collect():
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and len(r.kept) + r.n_removed == r.n_bytes


def test_automaton_names_the_earliest_document_of_every_window():
    rng = random.Random(3)
    for _ in range(30):
        seqs = [([rng.randrange(3) for _ in range(rng.randrange(1, 25))], rng.randrange(100)) for _ in range(rng.randrange(1, 8))]
        automaton, n = substring_dedup.Automaton(), 4
        for s, d in seqs:
            automaton.add(s, d)
        automaton.close()
        probe = [rng.randrange(3) for _ in range(60)]
        for s in [probe, *[s for s, _ in seqs]]:
            got = automaton.earliest(s, n)
            for i in range(len(s)):
                w = s[i - n + 1 : i + 1] if i >= n - 1 else None
                want = [d for t, d in seqs if w and any(t[j : j + n] == w for j in range(len(t)))]
                assert got[i] == (min(want) if want else substring_dedup.LAST)


def test_merged_transforms_equal_one_sort():
    rng = np.random.default_rng(5)
    for _ in range(20):
        strings = [np.append(rng.integers(1, 4, rng.integers(0, 9)), 0) for _ in range(rng.integers(1, 12))]
        letter = np.concatenate(strings)
        order, common = suffix_dedup.sorted_suffixes(letter, 8)
        ends = np.flatnonzero(letter == 0)
        suffix = [letter[i : ends[np.searchsorted(ends, i)]].tolist() for i in range(len(letter))]
        assert sorted(order.tolist()) == list(range(len(letter)))
        for k in range(1, len(order)):
            a, b = suffix[order[k - 1]], suffix[order[k]]
            assert a <= b
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            assert common[k] == n


def test_differing_regions_against_plain_windows():
    rng = random.Random(11)
    w, g = suffix_dedup.WINDOW, suffix_dedup.GRAM
    core = bytes(rng.randrange(97, 100) for _ in range(g))
    contents, left = [], []
    for _ in range(9):
        before = bytes(rng.choice(b"ab") for _ in range(rng.choice([0, 30, w - g])))
        after = bytes(rng.choice(b"ab") for _ in range(rng.choice([60, w - g])))
        shared = rng.randrange(0, 101)
        tail = (b"abababab" * 20)[:shared] + after
        contents.append((b"ba" * 60)[: 100 - len(before)] * (rng.random() < 0.5) + before + core + tail[: w - g])
        left.append(contents[-1].index(core))
    contents, left = zip(*{c: (c, n) for c, n in zip(contents, left)}.values())
    bounds = np.concatenate(([0], np.cumsum([len(c) for c in contents])))
    regions = Regions(
        np.zeros(len(contents), np.int64), np.arange(len(contents)), np.zeros(len(contents), np.int64), np.array(left), np.frombuffer(b"".join(contents), np.uint8), bounds
    )
    got = {(int(i), o) for i, a, b, _ in zip(*suffix_dedup.solve(regions)) for o in range(int(a), int(b) + 1)}
    places = {(i, o): c[left[i] - o :][:w] for i, c in enumerate(contents) for o in range(w - g + 1) if left[i] >= o and left[i] - o + w <= len(c)}
    count = Counter((o, s) for (_, o), s in places.items())
    assert got == {p for p, s in places.items() if count[(p[1], s)] > 1}
