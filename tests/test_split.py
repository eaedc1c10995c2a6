from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabweave.operators import split as S


@pytest.fixture(scope="module")
def rows(spark):
    y = F.when(F.col("id") % 10 == 0, 1).otherwise(0)
    return spark.range(1003).select("id", y.alias("y")).repartition(7).cache()


def test_split_sizes(rows):
    got = S.split_random(rows, ["id"], 0.2).groupBy("split").count().collect()
    assert dict(map(tuple, got)) == {"test": 201, "train": 802}
    again = {r["id"] for r in S.split_random(rows.repartition(3), ["id"], 0.2).where("split = 'test'").collect()}
    assert again == {r["id"] for r in S.split_random(rows, ["id"], 0.2).where("split = 'test'").collect()}
    assert again != {r["id"] for r in S.split_random(rows, ["id"], 0.2, seed=1).where("split = 'test'").collect()}


def test_stratified_split_keeps_ratio_and_total(rows):
    got = {(r["y"], r["split"]): r["count"] for r in S.split_stratified(rows, ["id"], "y", 0.2).groupBy("y", "split").count().collect()}
    assert got == {(0, "test"): 181, (0, "train"): 721, (1, "test"): 20, (1, "train"): 81}
    assert S.split_stratified(rows, ["id"], "y", 0.2).columns == ["id", "y", "split"]


def test_fold_sizes_follow_the_class_sorted_positions():
    counts = {0: 13, 1: 9, 2: 4}
    sizes = S.fold_sizes(counts, 5)
    y = np.repeat([0, 1, 2], [13, 9, 4])
    want = np.array([np.bincount(y[i::5], minlength=3) for i in range(5)]).T
    assert [sizes[c] for c in counts] == want.tolist()


@pytest.mark.parametrize("k", [2, 5])
def test_folds(rows, k):
    pdf = S.stratified_folds(rows, ["id"], "y", k).toPandas()
    assert len(pdf) == 1003 and set(pdf["fold"]) == set(range(k))
    assert pdf.groupby(["y", "fold"]).size().groupby("y").agg(lambda s: s.max() - s.min()).max() <= 1
    plain = S.plain_folds(rows, ["id"], k).toPandas()["fold"].value_counts()
    assert plain.max() - plain.min() <= 1 and plain.sum() == 1003


def test_more_folds_than_rows_of_a_class(frame):
    df = frame([(i, int(i == 0)) for i in range(7)], "id int, y int")
    pdf = S.stratified_folds(df, ["id"], "y", 5).toPandas()
    assert len(pdf) == 7 and sorted(Counter(pdf["fold"]).values()) == [1, 1, 1, 2, 2]


def test_null_class(frame):
    df = frame([(i, None if i % 2 else "a") for i in range(20)], "id int, y string")
    got = S.split_stratified(df, ["id"], "y", 0.2).groupBy("y", "split").count().collect()
    assert sorted((r["y"] or "", r["split"], r["count"]) for r in got) == [("", "test", 2), ("", "train", 8), ("a", "test", 2), ("a", "train", 8)]


def test_quota_sample(rows):
    got = {r["y"]: r["count"] for r in S.quota_sample(rows, ["id"], "y", 500).groupBy("y").count().collect()}
    assert got == {1: 101, 0: 399}
    few = {r["y"]: r["count"] for r in S.quota_sample(rows, ["id"], "y", 100).groupBy("y").count().collect()}
    assert few == {1: 25, 0: 75}


def test_first_of_each_class(frame):
    df = frame([(3, 1), (1, 0), (2, 1), (4, 0)], "id int, y int")
    got = S.first_of_each_class(df, "y", ["id"]).orderBy("wanted").collect()
    assert [(r["wanted"], r["id"]) for r in got] == [(0, 1), (1, 2)]
    none = S.first_of_each_class(df.where("y = 0"), "y", ["id"]).orderBy("wanted").collect()
    assert [(r["wanted"], r["id"]) for r in none] == [(0, 1), (1, 1)]
    ones = S.first_of_each_class(df.where("y = 1"), "y", ["id"]).orderBy("wanted").collect()
    assert [(r["wanted"], r["id"]) for r in ones] == [(0, 3), (1, 2)]


def test_sample(rows):
    assert S.sample_n(rows, ["id"], 100).count() == 100
    assert S.sample_n(rows, ["id"], 5000).count() == 1003
