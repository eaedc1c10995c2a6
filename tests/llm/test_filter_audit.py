"""The audit of filters against a plain walk through every order."""

import random
import re
from itertools import permutations

import numpy as np
import pytest

from tabweave.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, labels):
    """rows: (id, text, part). The contract, document by document."""
    parts = {}
    for i, t, p in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = set()
        fails |= {"A"} if len(w) < 50 else set()
        fails |= {"B"} if 100 * len(set(w)) < 65 * len(w) else set()
        fails |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        fails |= {"E"} if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows) else set()
        own = [(q, x) for j, q, x in labels if j == i and i is not None]
        parts.setdefault(p or "", []).append((fails, any(q == 1 for q, _ in own), any(x == 1 for _, x in own)))
    out = {}
    for p, docs in parts.items():
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                failing = sum(f in d[0] for d in docs)
                only = sum(d[0] == {f} for d in docs)
                total[f] += len(gone)
                out[p, "".join(order), step] = [len(left), len(gone), failing - len(gone), only, sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (q, order, step), v in out.items():
            if q == p:
                v.append(total[order[step - 1]])
    return out


def some_rows():
    rng = random.Random(6)
    texts = [None, "", " \n", "ONE two", "a # b", "é" * 40, "A" + "é" * 18, "A" + "é" * 19, "A" + "é" * 20]
    for _ in range(60):
        n = rng.choice([3, 49, 50, 51, 80, 200])
        kinds = rng.choice([20, 60, 1000])
        t = rng.choice([" ", "\n", "  "]).join(rng.choice(["w", "W", "wü"]) + str(rng.randrange(kinds)) for _ in range(n))
        texts.append(t + rng.choice(["", "", " 5%", " |"]))
    texts += [rng.choice(texts) for _ in range(40)]
    rows = [(i, t, rng.choice(["s1", "s1", "s2", None, "", "s3"])) for i, t in enumerate(texts)]
    rows += [(3, "other text", "s1"), (None, "ONE two", "s2"), (None, None, "s2"), rows[12], rows[12]]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 90)] + [(5, 1, 1), (5, 0, 0), (None, 1, 1), (9999, 1, 1)]
    return rows, labels


def test_every_order_against_a_plain_walk(spark):
    rows, labels = some_rows()
    docs = spark.createDataFrame([(*r, 1, "x", 2, b"d") for r in rows], "doc_id long, text string, source string, mask int, part string, row int, digest binary").repartition(5)
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").repartition(2)
    got = filter_audit.interactions(docs, said)
    want = plain(rows, labels)
    found = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in got.collect()}
    assert found == want and len(want) == 4 * 600
    assert dict(got.dtypes)["step"] == "int" and dict(got.dtypes)["shapley"] == "bigint"


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.interactions(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "a", None)], "doc_id long, text string, source string")
    assert {r.kept for r in filter_audit.interactions(one, labels).where("step = 5").collect()} == {0}


def test_lists():
    rng = np.random.default_rng(8)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 40, rng.integers(0, 30))) for _ in range(2))
        assert filter_audit.union(a, b).tolist() == np.union1d(a, b).tolist()
        assert filter_audit.difference(a, b).tolist() == np.setdiff1d(a, b).tolist()


def test_other_filters(spark):
    """Any masks can be audited: two filters, three rows to a mask."""
    rows = spark.createDataFrame([("p", i, i % 4, i, 1, 0) for i in range(12)], "part string, id long, mask int, row long, good int, toxic int")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.shapley) for r in filter_audit.audit(rows, "XY").collect()}
    assert got == {("XY", 1): (6, 6, 0, 3, 6, 9), ("XY", 2): (3, 3, 3, 3, 3, 9), ("YX", 1): (6, 6, 0, 3, 6, 9), ("YX", 2): (3, 3, 3, 3, 3, 9)}
    with pytest.raises(ValueError):
        filter_audit.audit(rows, "AA")
