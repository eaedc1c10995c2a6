import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tabweave.operators.cohorts import find_slices


def _plain(rows, features, min_share, min_effect, depth):
    """Every combination of conditions, broad ones first; those inside a told or too small slice are left out."""
    total, errors = len(rows), sum(bool(r[-1]) for r in rows)
    told, closed, out = [], [], {}
    for level in range(1, depth + 1):
        ended = []
        for fs in itertools.combinations(range(len(features)), level):
            for vs in {tuple(r[f] for f in fs) for r in rows}:
                s = frozenset(zip(fs, vs))
                if any(c < s for c in closed):
                    continue
                inside = [r for r in rows if all(r[f] == v for f, v in s)]
                n, e = len(inside), sum(bool(r[-1]) for r in inside)
                if n < min_share * total:
                    ended.append(s)
                    continue
                if n == total:
                    continue
                r, o = e / n, (errors - e) / (total - n)
                d = math.sqrt((r * (1 - r) + o * (1 - o)) / 2)
                effect = (r - o) / d if d > 0 else math.inf if r > o else 0.0
                if effect >= min_effect:
                    ended.append(s)
                    out[" AND ".join(f"`{features[f]}` IS NULL" if v is None else f"`{features[f]}` = '{v}'" for f, v in sorted(s, key=lambda x: x[0]))] = (level, n, e)
        closed += ended
    return out


@pytest.mark.parametrize("effect", [0.15, 0.4])
def test_slices_equal_exhaustive_search(frame, effect):
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        a, b, c = rng.choice("xyz"), rng.choice(["p", "q", None]), rng.choice("uvw")
        rows.append((a, b, c, rng.random() < (0.8 if (a, b) == ("x", None) or (b, c, a) == ("q", "w", "z") else 0.2)))
    df = frame(rows, "a string, b string, c string, wrong boolean")
    got = find_slices(df, F.col("wrong"), ["a", "b", "c"], 0.03, effect, depth=3).collect()
    want = _plain(rows, ["a", "b", "c"], 0.03, effect, 3)
    assert {r["slice"]: (r["level"], r["n"], r["errors"]) for r in got} == want and want
    assert all(df.where(r["slice"]).count() == r["n"] for r in got)


def test_slices_of_odd_tables(frame):
    schema = "`odd name` string, wrong boolean"
    assert find_slices(frame([], schema), F.col("wrong"), ["odd name"]).count() == 0
    certain = find_slices(frame([("it's", True), ("it's", True), ("b", False), ("b", None)], schema), F.col("wrong"), ["odd name"]).collect()
    assert len(certain) == 1 and certain[0]["effect"] == math.inf and (certain[0]["n"], certain[0]["errors"]) == (2, 2)
    same = frame([("a", True), ("a", False)], schema)
    assert find_slices(same, F.col("wrong"), ["odd name"]).count() == 0
