import numpy as np
import pyarrow as pa

from tabweave.llm.arrays import Texts, covered, minimizers, runs, sliding_min, text_of, texts


def test_words_match_split_and_equal_words_have_equal_hashes():
    cells = ["a bb  ccc\x0b dd", "", None, "bb", " \n", "ccc é\x1cé"]
    (t,) = texts(pa.array(cells))
    first, last = t.spans
    raw = t.data.tobytes()
    found = [raw[a:b] for a, b in zip(first, last)]
    assert found == [w for c in cells for w in (c or "").encode().split()]
    names = dict(zip(t.words.tolist(), found))
    assert len(names) == len(set(found)) and all(names[h] == w for h, w in zip(t.words.tolist(), found))
    assert np.diff(t.word_bounds).tolist() == [len((c or "").encode().split()) for c in cells]


def test_chunks_hold_whole_texts_and_long_texts_stand_alone():
    cells = ["x" * 10, "y" * 50, "z" * 5, "", "u" * 5]
    parts = list(texts(pa.array(cells).slice(1), 12))
    assert [p.first for p in parts] == [0, 1] and [len(p) for p in parts] == [1, 3]
    assert parts[0].data.tobytes() == b"y" * 50
    assert not list(texts(pa.array([], pa.string())))


def test_runs_stay_inside_texts():
    values = np.array([1, 2, 3, 1, 2, 3, 9], np.uint64)
    bounds = np.array([0, 3, 3, 6, 7])
    at, hashes = runs(values, bounds, 3)
    assert at.tolist() == [0, 3] and hashes[0] == hashes[1]
    assert text_of(np.array([0, 2, 3, 6]), bounds).tolist() == [0, 0, 2, 3]
    assert not len(runs(values[:2], np.array([0, 2]), 3)[0])


def test_minimizers_cover_every_window():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 50, 300).astype(np.uint64)
    for n in (1, 2, 7, 300, 400):
        chosen = minimizers(values, n)
        m = min(n, len(values))
        want = np.zeros(len(values), bool)
        for i in range(len(values) - m + 1):
            want[i : i + m] |= values[i : i + m] == values[i : i + m].min()
        assert (chosen == want).all()
        assert (sliding_min(values, m) == [values[i : i + m].min() for i in range(len(values) - m + 1)]).all()


def test_covered():
    assert covered(np.array([1, 2]), np.array([3, 5]), 6).tolist() == [False, True, True, True, True, False]
    assert Texts(0, np.zeros(0, np.uint8), np.zeros(1, np.int64)).words.tolist() == []
