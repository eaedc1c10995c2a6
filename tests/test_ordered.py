import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabweave.plans import ordered as O

relaxed = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def skewed(n):
    rng = np.random.default_rng(7)
    v = np.exp(rng.normal(size=n) * 3)
    v[: n // 3] = 5.0
    return v


@pytest.mark.parametrize("limit", [10, 200, 4000, 1_000_000])
def test_quantiles_with_a_hot_value(spark, limit):
    v = skewed(5000)
    df = spark.createDataFrame([(float(x), float(i % 3)) for i, x in enumerate(v)], "v double, few double").repartition(5)
    got = O.exact_quantiles(df, {"v": PROBS, "few": PROBS}, limit)
    assert got["v"] == pytest.approx(list(np.quantile(v, PROBS)), rel=1e-12)
    assert got["few"] == pytest.approx(list(np.quantile(np.arange(5000) % 3, PROBS)))


def test_quantiles_when_the_sketch_is_useless(spark, monkeypatch):
    monkeypatch.setattr(O, "SKETCH_ACCURACY", 2)
    v = skewed(1500)
    df = spark.createDataFrame([(float(x),) for x in v], "v double").repartition(2)
    got = O.exact_quantiles(df, {"v": [0.3]}, 60)
    assert got["v"] == pytest.approx(list(np.quantile(v, [0.3])), rel=1e-12)


@relaxed
@given(st.lists(st.floats(-1e6, 1e6) | st.none() | st.just(float("nan")), max_size=60))
def test_quantiles_property(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    kept = [v for v in values if v is not None and v == v]
    for limit in (4, 1000):
        got = O.exact_quantiles(df, {"v": [0.25, 0.5]}, limit)["v"]
        want = [None, None] if not kept else list(np.quantile(kept, [0.25, 0.5]))
        assert got == (want if not kept else pytest.approx(want, rel=1e-9, abs=1e-9))


def test_prefix_sums_over_many_ranges(spark):
    df = spark.range(3000).select((F.col("id") * 7 % 1000).cast("double").alias("k"), (F.col("id") % 2).alias("g"))
    bounds = O.key_boundaries(df, "k", one_task_keys=50)
    assert len(bounds) > 5 and bounds == sorted(bounds)
    groups = df.groupBy("g", "k").agg(F.count("*").alias("c"))
    got = O.prefix_sums(groups, "k", ["c"], bounds, ["g"]).toPandas().sort_values(["g", "k"])
    want = got.groupby("g")["c"].cumsum() - got["c"]
    assert (got["c_before"] == want).all()
    plain = O.prefix_sums(groups, "k", ["c"], [], ["g"]).toPandas().sort_values(["g", "k"])
    assert (plain["c_before"].to_numpy() == got["c_before"].to_numpy()).all()


def test_boundaries_for_text(spark):
    df = spark.range(4000).select(F.md5(F.col("id").cast("string")).alias("k"))
    bounds = O.key_boundaries(df, "k", one_task_keys=100)
    sizes = O.with_range(df, "k", bounds, "r").groupBy("r").count().toPandas()
    assert len(bounds) > 10 and sizes["count"].max() < 4000 / len(bounds) * 6
    assert O.key_boundaries(df, "k", one_task_keys=100_000) == []


@pytest.mark.parametrize("fetch", [1, 400, 1_000_000])
@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_cutoffs_pick_exact_ranks(spark, fetch, method):
    # One class holds two thirds of the rows.
    df = spark.range(6000).select("id", F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 5 > 0, "b").alias("y"))
    order = O.RowOrder(["id"], 1, method)
    cut = O.rank_cutoffs(df, order, lambda c: {y: [0, 1, n // 2, n] for y, n in c.items()}, "y", fetch)
    got = O.blocks_before(df, cut, order, "y").toPandas()
    for y, part in got.groupby("y", dropna=False):
        n = len(part)
        counts = part["_block"].value_counts().to_dict()
        assert counts == {1: 1, 2: n // 2 - 1, 3: n - n // 2}


@pytest.mark.parametrize("n", [0, 5, 1000, 5000])
def test_take_smallest_takes_the_first(spark, n):
    df, order = spark.range(1000), O.RowOrder(["id"])
    want = {r[0] for r in df.withColumn("o", order.column()).orderBy("o").limit(n).collect()}
    got = [r[0] for r in O.take_smallest(df, order, n).collect()]
    assert set(got) == want and len(got) == min(n, 1000)


@pytest.mark.parametrize("n", [19_999, 20_000, 20_001])
def test_take_smallest_is_exact_with_equal_keys(spark, n):
    df = spark.range(30_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("v"))
    got = O.take_smallest(df, O.RowOrder(["k"]), n)
    assert got.count() == n and got.schema == df.schema
    assert got.exceptAll(df).isEmpty()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, O.take_smallest(df.repartition(7), O.RowOrder(["k"]), n).collect()))


def test_many_classes(spark):
    df = spark.range(24_000).select("id", (F.col("id") % 12_000).alias("y"))
    order = O.RowOrder(["id"])
    cut = O.rank_cutoffs(df, order, lambda c: {y: [1] for y in c}, "y")
    blocks = O.blocks_before(df, cut, order, "y").groupBy("y").agg(F.count_if(F.col("_block") == 0).alias("n"))
    assert blocks.where("n <> 1").isEmpty() and len(cut.classes) == 12_000


def test_quantiles_among_infinite_values(frame):
    inf = float("inf")
    df = frame([(x,) for x in [-inf, 1.0, 2.0, inf, inf, inf, inf]], "v double")
    assert O.exact_quantiles(df, {"v": [0.0, 0.25, 0.75, 0.9]}, 4)["v"] == [-inf, 1.5, inf, inf]
