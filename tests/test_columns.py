import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabweave.functions import columns as C


def values(df, *names):
    return [tuple(r) if len(names) > 1 else r[0] for r in df.select(*names).collect()]


def test_bins_are_right_closed_and_drop_what_is_outside(frame):
    df = frame([(x,) for x in (0.0, 0.5, 40.0, 40.1, 120.0, 121.0, None)], "age double")
    edges, labels = [0, 40, 55, 70, 120], ["Y", "M", "S", "E"]
    out = df.select(C.bin_label(F.col("age"), edges, labels).alias("l"), C.bin_code(F.col("age"), edges).alias("c"))
    assert values(out, "l") == [None, "Y", "Y", "M", "E", None, None]
    assert values(out, "c") == [None, 0, 0, 1, 3, None, None]


@pytest.mark.parametrize(
    "edges,labels",
    [([0, 1, 1], ["a", "b"]), ([2, 1, 0], ["a", "b"]), ([0, 1, 2], ["a"]), ([0, 1, 2], ["a", "a"]), ([0], [])],
)
def test_bad_edges(edges, labels):
    with pytest.raises(ValueError):
        C.check_edges(edges, labels)


@pytest.mark.parametrize("vals,n", [([0, 5, 10], 2), ([1, 50], 7), ([3, 3], 2), ([0.0, 0.0], 3), ([-2.5, 9.1], 4)])
def test_equal_width_edges_match_pandas(vals, n):
    _, want = pd.cut(pd.Series(vals, dtype=float), n, retbins=True)
    assert C.equal_width_edges(min(vals), max(vals), n) == pytest.approx(list(want), abs=1e-12)


@pytest.mark.parametrize(
    "vals,bins", [([0.0, 5.0, 10.0], 2), ([1, 20, 40], [0, 10, 20, 50]), ([1.0, 20.0], [0, 18.5, 25.0]), ([0.00012, 0.00091], 3)]
)
def test_interval_labels_match_pandas(vals, bins):
    cats = pd.cut(pd.Series(vals), bins).cat.categories
    edges = bins if isinstance(bins, list) else C.equal_width_edges(min(vals), max(vals), bins)
    assert C.interval_labels(edges) == [str(c) for c in cats]


def test_date_parts_count_monday_as_zero(frame):
    df = frame([("2024-01-01 13:00:00",), (None,)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    parts = ["year", "month", "day", "dayofweek", "quarter", "hour"]
    out = df.select(*[C.date_part(F.col("t"), p).alias(p) for p in parts]).collect()
    assert tuple(out[0]) == (2024, 1, 1, 0, 1, 13)
    assert tuple(out[1]) == (None,) * 6
    with pytest.raises(ValueError):
        C.date_part(F.col("t"), "minute")


def test_labels_and_risk(frame):
    df = frame([("True", 0.5), ("1", 0.51), ("False", 0.0), ("x", 1.0), (None, 0.2)], "p string, s double")
    out = df.select(C.truthy_label(F.col("p")).alias("l"), C.risk_level(F.col("s")).alias("r"))
    assert values(out, "l") == [1, 1, 0, 0, 0]
    assert values(out, "r") == ["LOW RISK", "HIGH RISK", "LOW RISK", "HIGH RISK", "LOW RISK"]


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_hash_is_even_and_positive(spark, method):
    df = spark.range(20000).select(C.hash_percent([F.col("id")], 42, method).alias("b"))
    got = df.groupBy("b").count().agg(F.min("b"), F.max("b"), F.min("count"), F.max("count")).first()
    assert got[0] == 0 and got[1] == 99 and got[2] > 130 and got[3] < 280
