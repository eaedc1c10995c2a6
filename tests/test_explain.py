import itertools
import math

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from tabweave.functions.columns import linear_score
from tabweave.operators import explain as E


def brute_shapley(v, m):
    phi = np.zeros(m)
    for j in range(m):
        rest = [i for i in range(m) if i != j]
        for k in range(m):
            for s in itertools.combinations(rest, k):
                w = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
                phi[j] += w * (v(frozenset(s) | {j}) - v(frozenset(s)))
    return phi


def leaf_value_game(leaves, x):
    def v(s):
        total = 0.0
        for leaf in leaves:
            p = leaf.value
            for f, lo, hi, ok, z in zip(leaf.features, leaf.lows, leaf.highs, leaf.accepted, leaf.shares):
                inside = lo < x[f] <= hi and (ok is None or int(x[f]) in ok)
                p *= (1.0 if inside else 0.0) if f in s else z
            total += p
        return total

    return v


@pytest.fixture(scope="module")
def training(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3)).round(2)
    c = rng.integers(0, 4, 400)
    y = (x[:, 0] * x[:, 1] + (c == 2) + 0.3 * x[:, 2] > 0.2).astype(float)
    rows = [(i, *map(float, x[i]), float(c[i]), float(y[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, k double, y double")
    # The indexer's metadata makes k a categorical feature of the trees.
    coded = StringIndexer(inputCol="k", outputCol="kk", stringOrderType="alphabetAsc").fit(df).transform(df).drop("k")
    return VectorAssembler(inputCols=["a", "b", "c", "kk"], outputCol="features").transform(coded).cache()


FEATS = ["a", "b", "c", "kk"]


@pytest.mark.parametrize(
    "make",
    [
        lambda: RandomForestClassifier(labelCol="y", numTrees=3, maxDepth=5, seed=1),
        lambda: GBTClassifier(labelCol="y", maxIter=3, maxDepth=4, seed=1),
        lambda: DecisionTreeRegressor(labelCol="y", maxDepth=6),
    ],
)
def test_tree_attribution_equals_enumeration(training, make):
    estimator = make()
    model = estimator.fit(training)
    leaves = E.model_leaves(model)
    assert any(ok is not None for leaf in leaves for ok in leaf.accepted)
    out = E.tree_attribution(training, ["id"], FEATS, model).df.orderBy("id").limit(12).toPandas()
    for r in out.itertuples():
        want = brute_shapley(leaf_value_game(leaves, [getattr(r, f) for f in FEATS]), 4)
        assert [getattr(r, f"phi_{f}") for f in FEATS] == pytest.approx(list(want), abs=1e-10)
    scored = model.transform(training)
    if isinstance(estimator, DecisionTreeRegressor):
        output = F.col("prediction")
    elif isinstance(estimator, RandomForestClassifier):
        output = vector_to_array("probability")[1]
    else:
        output = vector_to_array("rawPrediction")[1]
    a = E.tree_attribution(scored.withColumn("out", output.cast("double")), ["id", "out"], FEATS, model)
    total = sum((a.phi(f) for f in FEATS), F.col("base_value"))
    # The margin of boosted trees is reported as (-m, m).
    assert a.df.agg(F.max(F.abs(total - F.col("out")))).first()[0] < 1e-9


def random_tree(rng, depth, m, categorical=()):
    t = E.Tree([], [], [], [], [], [], [], [])

    def grow(d):
        i = len(t.features)
        for column in (t.features, t.cuts, t.chosen, t.arity, t.left, t.right, t.values, t.shares):
            column.append(None)
        t.features[i], t.cuts[i], t.left[i], t.right[i], t.values[i] = -1, math.nan, -1, -1, float(rng.normal())
        t.shares[i] = 1.0
        if d and rng.random() < 0.9:
            f = t.features[i] = int(rng.integers(0, m))
            if f in categorical:
                t.arity[i] = 4
                t.chosen[i] = frozenset(rng.choice(4, rng.integers(1, 4), replace=False).tolist())
            else:
                t.cuts[i] = round(rng.random(), 1)
            t.left[i], t.right[i] = grow(d - 1), grow(d - 1)
            t.shares[t.left[i]] = float(rng.uniform(0.1, 0.9))
            t.shares[t.right[i]] = 1 - t.shares[t.left[i]]
        return i

    grow(depth)
    return t


def expected_given(t, i, x, s):
    """What a tree gives on average when the features in s are known."""
    f = t.features[i]
    if f < 0:
        return t.values[i]
    left, right = t.left[i], t.right[i]
    if f in s:
        goes_left = x[f] <= t.cuts[i] if t.chosen[i] is None else x[f] in t.chosen[i]
        return expected_given(t, left if goes_left else right, x, s)
    return t.shares[left] * expected_given(t, left, x, s) + t.shares[right] * expected_given(t, right, x, s)


@pytest.mark.parametrize(("depth", "m", "categorical"), [(3, 2, ()), (6, 4, (1,)), (7, 5, (0, 4)), (1, 3, ())])
def test_table_and_walk_equal_enumeration(depth, m, categorical):
    rng = np.random.default_rng(depth)
    trees = [random_tree(rng, depth, m, categorical) for _ in range(5)]
    x = rng.random((25, m)).round(1)
    x[:, list(categorical)] = rng.integers(0, 6, (25, len(categorical)))
    x[rng.random(x.shape) < 0.05] = np.nan
    leaves = [E.astuple(leaf) for leaf in E.tree_leaves(trees)]
    assert E.GridShares.fits(leaves)
    grid, walk = E.GridShares(leaves), E.PathShares(trees)
    want = np.array([sum(brute_shapley(lambda s: expected_given(t, 0, r, s), m) for t in trees) for r in x])
    assert np.allclose(grid.phi(x), want) and np.allclose(walk.phi(x), want)
    assert grid.base == pytest.approx(walk.base) == pytest.approx(sum(expected_given(t, 0, x[0], ()) for t in trees))


def test_wide_trees_are_walked_and_add_up(monkeypatch):
    rng = np.random.default_rng(11)
    trees = [random_tree(rng, 9, 30) for _ in range(4)]
    x = rng.random((300, 30))
    monkeypatch.setattr(E, "WALK_ROWS", 128)
    shares = E.tree_shares(trees)
    assert isinstance(shares, E.PathShares)
    output = [sum(expected_given(t, 0, r, range(30)) for t in trees) for r in x]
    assert np.allclose(shares.phi(x).sum(axis=1) + shares.base, output)


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(2)
    rows = [(i, *map(float, rng.normal(size=3).round(3))) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double").cache()
    return df, {"a": 1.0, "b": -3.0, "c": 0.5}


def test_linear_attribution_adds_up(linear):
    df, w = linear
    a = E.linear_attribution(df, ["id"], w, 0.7, E.background_means(df, list(w)))
    total = sum((a.phi(f) for f in w), F.col("base_value"))
    assert a.df.agg(F.max(F.abs(total - linear_score(w, 0.7)))).first()[0] < 1e-12
    assert E.long_table(a).count() == 150
    rank = E.importance(a).collect()
    assert [r["rank"] for r in rank] == [1, 2, 3] and rank[0]["feature"] == "b"
    assert E.top_features(a, 1) == ["b"]
    assert E.importance(a, 2).count() == 2
    fall = E.waterfall(a, top=1).where("id = 3").orderBy("rank").collect()
    assert len(fall) == 2 and fall[1]["feature"] == "other"
    row = a.df.where("id = 3").first()
    parts = sorted((row[f"phi_{f}"] for f in w), key=abs, reverse=True)
    assert fall[0]["shap"] == parts[0] and fall[1]["shap"] == pytest.approx(sum(parts[1:]))
    assert E.waterfall(a, top=3).where("id = 3").count() == 3
    assert E.dependence(a, [0, "c"]).select("feature").distinct().count() == 2
    with pytest.raises(ValueError):
        E.dependence(a, ["zz"])
    assert E.force_rows(a, 5).count() == 15
    q = E.distribution(a, [0.5], top=2).collect()
    phis = [r["phi_b"] for r in a.df.collect()]
    assert q[0]["feature"] == "b" and q[0]["q50"] == pytest.approx(float(np.median(phis)))
    assert {r["direction"] for r in E.stats_report(a).collect()} <= {"up", "down"}


def test_explain_all_writes_its_tables(linear, spark, tmp_path):
    df, w = linear
    paths = E.explain_all(E.linear_attribution(df, ["id"], w, 0.0, E.background_means(df, list(w))), str(tmp_path / "x"))
    assert set(paths) == {"values", "importance", "stats", "summary", "waterfall", "dependence", "force"}
    assert spark.read.parquet(paths["waterfall"]).select("id").distinct().collect()[0][0] == 0
    assert spark.read.parquet(paths["dependence"]).count() == 50


def test_kernel_attribution_equals_enumeration(linear):
    df, _ = linear
    back = df.orderBy("id").limit(4)
    b = np.array([[r["a"], r["b"], r["c"]] for r in back.collect()])

    def score(d):
        return d.withColumn("score", F.col("a") * F.col("b") + F.exp(F.col("c")))

    f = lambda x: x[..., 0] * x[..., 1] + np.exp(x[..., 2])
    got = E.kernel_attribution(df, ["id"], ["a", "b", "c"], back, score).df.orderBy("id").limit(5).collect()
    for r in got:
        x = np.array([r["a"], r["b"], r["c"]])

        def v(s):
            mixed = b.copy()
            for j in s:
                mixed[:, j] = x[j]
            return f(mixed).mean()

        want = brute_shapley(v, 3)
        assert [r["phi_a"], r["phi_b"], r["phi_c"]] == pytest.approx(list(want))
        assert r["base_value"] + want.sum() == pytest.approx(r["output"]) == pytest.approx(float(f(x)))


def test_sampled_coalitions_stay_additive_and_exact_for_additive_games():
    masks, c = E.coalition_weights(14, "sampled", coalitions=400)
    w = np.arange(14) - 5.0
    v = np.array([2.0 + sum(w[j] for j in range(14) if s >> j & 1) for s in masks])
    assert list(c @ v) == pytest.approx(list(w))
    u = v + 0.3 * np.array([(s & 1) * (s >> 3 & 1) for s in masks])
    assert (c @ u).sum() == pytest.approx(u[-1] - u[0])


def test_positive_class(frame):
    df = frame([(0, 0.1), (1, 0.2)], "class int, shap double")
    assert [tuple(r) for r in E.positive_class(df).collect()] == [(0.2,)]


def test_kernel_keeps_equal_rows_apart_and_takes_features_as_keys(frame):
    rows = frame([(1, 2.0, 3.0), (1, 2.0, 3.0), (2, 0.0, 1.0)], "k int, a double, b double")
    back = frame([(0.0, 0.0)], "a double, b double")
    a = E.kernel_attribution(rows, ["k", "a"], ["a", "b"], back, lambda d: d.withColumn("score", F.col("a") + F.col("b")))
    got = sorted((r["k"], r["a"], r["phi_a"], r["phi_b"], r["base_value"]) for r in a.df.collect())
    assert got == [(1, 2.0, 2.0, 3.0, 0.0), (1, 2.0, 2.0, 3.0, 0.0), (2, 0.0, 0.0, 1.0, 0.0)]
    with pytest.raises(ValueError):
        E.coalition_weights(3, "some")


def test_tables_of_shares_equal_the_single_leaves():
    rng = np.random.default_rng(1)
    leaves = []
    for _ in range(40):
        d = int(rng.integers(0, 5))
        fs = sorted(rng.choice(6, d, replace=False).tolist())
        lows = [float(rng.choice([-np.inf, 0.2])) for _ in fs]
        highs = [float(rng.choice([np.inf, 0.7])) for _ in fs]
        some = [frozenset([0, 1]) if rng.random() < 0.2 else None for _ in fs]
        leaves.append((float(rng.normal()), fs, lows, highs, some, rng.random(d).tolist()))
    x = rng.random((50, 6)).round(1)
    x[rng.random(x.shape) < 0.1] = np.nan
    want = np.zeros_like(x)
    for value, fs, lows, highs, some, shares in leaves:
        for r in range(len(x)):
            met = []
            for f, lo, hi, s in zip(fs, lows, highs, some):
                v = x[r, f]
                ok = (hi == np.inf) if np.isnan(v) else lo < v <= hi
                met.append(ok and (s is None or v in s))
            for f, p in zip(fs, brute_shapley(lambda c: value * np.prod([met[j] if j in c else shares[j] for j in range(len(fs))]), len(fs))):
                want[r, f] += p
    assert np.allclose(E.tree_phi(x, leaves), want)


def test_array_attribution_equals_enumeration_and_multiplies_no_rows(linear, monkeypatch):
    df, _ = linear
    curved = lambda x: x[:, 0] * x[:, 1] + np.exp(x[:, 2])
    back = df.orderBy("id").limit(4)
    b = np.array([[r["a"], r["b"], r["c"]] for r in back.collect()])
    for at_once in (1, 40, 1 << 21):
        monkeypatch.setattr(E, "SCORED_AT_ONCE", at_once)
        a = E.array_attribution(df, ["id", "a"], ["a", "b", "c"], back, curved)
        assert a.df.columns == ["id", "a", "b", "c", "phi_a", "phi_b", "phi_c", "base_value", "output"]
        plan = a.df._jdf.queryExecution().toString()
        assert "Generate" not in plan and "Aggregate" not in plan and a.df.count() == df.count()
        for r in a.df.orderBy("id").limit(5).collect():
            x = np.array([[r["a"], r["b"], r["c"]]])

            def v(s):
                mixed = b.copy()
                for j in s:
                    mixed[:, j] = x[0, j]
                return curved(mixed).mean()

            assert [r["phi_a"], r["phi_b"], r["phi_c"]] == pytest.approx(list(brute_shapley(v, 3)))
            assert (r["base_value"], r["output"]) == pytest.approx((v(()), float(curved(x)[0])))


def test_sampled_coalitions_are_exact_for_products_of_two():
    rng = np.random.default_rng(3)
    back, x = rng.normal(size=(6, 9)), rng.normal(size=(3, 9))
    w = rng.normal(size=9)
    phi, _, _ = E.CoalitionScores(lambda z: z @ w + z[:, 2] * z[:, 7], back, "sampled", 60).phi(x)
    exact, _, _ = E.CoalitionScores(lambda z: z @ w + z[:, 2] * z[:, 7], back).phi(x)
    assert np.allclose(phi, exact)


def test_background_is_checked(linear, monkeypatch):
    df, _ = linear
    with pytest.raises(ValueError):
        E.background_values(df.limit(0), ["a"])
    monkeypatch.setattr(E, "BACKGROUND_BYTES", 8 * 49)
    with pytest.raises(ValueError):
        E.background_values(df, ["a"])
    assert E.background_values(df.limit(49), ["a"]).shape == (49, 1)


def test_models_in_array_form(frame):
    from pyspark.ml.linalg import Vectors

    from tabweave.operators import models as G

    rng = np.random.default_rng(7)
    rows = frame([(i, *map(float, rng.normal(size=2)), float(i % 3)) for i in range(90)], "id int, a double, b double, y double")
    t = G.train(rows, ["a", "b"], "y", "logistic_regression")
    a = E.attribute_model(t, rows, ["id"], rows.limit(10), target_class=2)
    want = {r.id: r.p2 for r in t.score(rows, ["id"]).collect()}
    got = a.df.collect()
    assert len(got) == 90 and all(r.output == pytest.approx(want[r.id]) == pytest.approx(r.base_value + r.phi_a + r.phi_b) for r in got)
    line = G.train(rows, ["a"], "b", "linear_regression", "regression")
    score = E.array_form(line.model.stages[-1])
    assert score(np.array([[2.0]]))[0] == pytest.approx(line.model.stages[-1].predict(Vectors.dense(2.0)))
    assert E.array_form(object()) is None


def test_few_input_partitions_become_tasks_for_all_cores(spark):
    df = spark.range(40).select("id", F.col("id").cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("z")).coalesce(1)
    back = df.limit(5)
    tasks = E.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    seen = []

    def score(rows):
        seen.append(rows.rdd.getNumPartitions())
        return rows.withColumn("score", F.col("x") * F.col("z"))

    by_rows = E.kernel_attribution(df, ["id"], ["x", "z"], back, score)
    arrays = E.array_attribution(df, ["id"], ["x", "z"], back, lambda v: v[:, 0] * v[:, 1])
    assert seen == [tasks] and arrays.df.rdd.getNumPartitions() == tasks
    each = [[tuple(round(v, 9) for v in r) for r in a.df.select("id", "phi_x", "phi_z", "base_value").orderBy("id").collect()] for a in (by_rows, arrays)]
    assert each[0] == each[1] and len(each[0]) == 40
