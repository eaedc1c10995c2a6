import os
import pickle
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabweave.operators import cells as K
from tabweave.operators import explain as E
from tabweave.operators import models as G


@pytest.fixture
def on_cells(monkeypatch):
    monkeypatch.setattr(K, "CELLS_FROM", 1)


def _rows(spark, n=3000):
    noise = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(10)) < 2
    df = spark.range(n).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.pmod(F.xxhash64("id"), F.lit(5)) / 2).alias("b"))
    return df.withColumn("y", ((F.col("a") > 3) != noise).cast("double")).withColumn("v", F.col("a") * 2 + F.col("b") + noise.cast("int"))


def _scores(t, df, c):
    return np.array([r[c] for r in t.score(df, ["id"]).orderBy("id").collect()])


@pytest.mark.parametrize("label,task,column", [("y", "classification", "p1"), ("v", "regression", "prediction")])
def test_boosting_on_cells_equals_boosting_on_rows(spark, monkeypatch, label, task, column):
    df = _rows(spark).select("id", "a", "b", label)
    plain = _scores(G.train(df, ["a", "b"], label, "gradient_boosting", task, maxIter=5, maxDepth=3), df, column)
    monkeypatch.setattr(K, "CELLS_FROM", 1)
    t = G.train(df, ["a", "b"], label, "gradient_boosting", task, maxIter=5, maxDepth=3)
    assert t.model.stages[-1].getMaxBins() == K.ALL_VALUES
    np.testing.assert_allclose(_scores(t, df, column), plain, atol=1e-9)


@pytest.mark.parametrize("label,task,column", [("y", "classification", "p1"), ("v", "regression", "prediction")])
def test_forests_on_cells_count_rows(spark, on_cells, label, task, column):
    df = _rows(spark).select("id", "a", "b", label)
    t = G.train(df, ["a", "b"], label, "random_forest", task, numTrees=12, maxDepth=6, featureSubsetStrategy="all")
    forest = t.model.stages[-1]
    assert forest.getNumTrees == 12 and len(forest.trees) == 12
    means = np.array([r["m"] for r in df.join(df.groupBy("a", "b").agg(F.avg(label).alias("m")), ["a", "b"]).orderBy("id").collect()])
    assert np.abs(_scores(t, df, column) - means).max() < 0.15
    again = G.train(df.repartition(3), ["a", "b"], label, "random_forest", task, numTrees=12, maxDepth=6, featureSubsetStrategy="all")
    if task == "classification":
        np.testing.assert_array_equal(_scores(again, df, column), _scores(t, df, column))
    out = t.score(df, ["id", "a", "b"])
    a = E.tree_attribution(out, ["id", column], ["a", "b"], forest)
    assert a.df.agg(F.max(F.abs(F.col("base_value") + F.col("phi_a") + F.col("phi_b") - F.col(column)))).first()[0] < 1e-9
    # The base value weighs leaves by rows: it is the mean of the bootstraps, not of the cells.
    assert abs(a.df.first()["base_value"] - df.agg(F.avg(label)).first()[0]) < 0.05 * max(1.0, means.mean())


def test_leaves_keep_their_least_number_of_rows(spark, on_cells):
    df = spark.range(1000).select("id", (F.col("id") == 0).cast("double").alias("a"), (F.col("id") == 0).cast("double").alias("y"))
    t = G.train(df, ["a"], "y", "gradient_boosting", maxIter=1, maxDepth=2, minInstancesPerNode=2)
    assert t.model.stages[-1].trees[0].numNodes == 1
    assert G.train(df, ["a"], "y", "gradient_boosting", maxIter=1, maxDepth=2).model.stages[-1].trees[0].numNodes == 3


def test_classes_a_sample_misses_keep_their_place(spark, on_cells):
    df = spark.range(400).select("id", (F.col("id") % 4).cast("double").alias("a"), F.when(F.col("id") == 0, 2).otherwise(F.col("id") % 2).cast("double").alias("y"))
    t = G.train(df, ["a"], "y", "random_forest", numTrees=9, maxDepth=2)
    assert t.model.stages[-1].numClasses == 3
    assert len(t.score(df, ["id"]).first()) == 5


def test_bins_follow_the_rows(frame):
    values = [0.0] * 500 + [float(i) for i in range(1, 301)] + [1e12 + i for i in range(200)]
    df = frame([(v,) for v in values], "a double")
    got = K.bin_values(df, {"a": (0.0, max(values))}, 32)["a"]
    assert len(got) <= 32 and got[0] == 0.0
    assert 8 <= sum(0 < v < 1000 for v in got) and 5 <= sum(v >= 1e12 for v in got)
    few = frame([(v,) for v in [1.0, 1.0 + 1e-9, 5e15, -3.0]], "a double")
    assert K.bin_values(few, {"a": (-3.0, 5e15)}, 32)["a"].tolist() == [-3.0, 1.0, 1.0 + 1e-9, 5e15]


def test_values_that_are_missing_are_still_an_error(frame, on_cells):
    df = frame([(1.0, 0.0), (None, 1.0)], "a double, y double")
    with pytest.raises(Exception):
        G.train(df, ["a"], "y", "random_forest", numTrees=2)


def test_a_level_of_all_trees_is_one_job(spark, on_cells):
    df = _rows(spark).select("id", "a", "b", (F.col("a") % 2).alias("y"))
    spark.sparkContext.setJobGroup("grown", "")
    try:
        t = G.train(df, ["a", "b"], "y", "random_forest", numTrees=24, maxDepth=3)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("grown"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert t.model.stages[-1].getNumTrees == 24 and 0 < jobs < 24 * 3
    assert max(tree.depth for tree in t.model.stages[-1].trees) == 3
    assert abs(sum(t.model.stages[-1].featureImportances.toArray()) - 1) < 1e-9


@pytest.mark.parametrize("kind,size", [("random_forest", {"numTrees": 5}), ("gradient_boosting", {"maxIter": 5})])
def test_rows_score_by_cells_as_by_the_trees(spark, on_cells, kind, size):
    df = _rows(spark).select("id", "a", "b", "y")
    t = G.train(df, ["a", "b"], "y", kind, maxDepth=4, **size)
    odd = df.select("id", (F.col("a") * 1.3 - 2).alias("a"), (F.col("b") + F.col("id") % 3 / 8).alias("b"))
    plain = t.transform(odd).select("id", "prediction", G.vector_to_array("probability")[0], G.vector_to_array("probability")[1])
    out = t.score(odd, ["id"])
    assert "arrow" in out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, plain.collect()))
    assert t.score(odd.limit(0), ["id"]).count() == 0


def test_attributions_reach_workers_without_this_package(spark, monkeypatch, tmp_path):
    df = spark.range(60).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 2).cast("double").alias("y"))
    model = G.train(df, ["a"], "y", "random_forest", numTrees=2, maxDepth=2).model.stages[-1]
    sent = []
    context = type(spark.sparkContext)
    kept = context.broadcast
    monkeypatch.setattr(context, "broadcast", lambda self, value: sent.append(value) or kept(self, value))
    E.tree_attribution(df, ["id"], ["a"], model)
    load = "import pickle, sys; v = pickle.loads(sys.stdin.buffer.read()); pickle.loads(v) if isinstance(v, bytes) else v"
    for value in sent:
        subprocess.run([sys.executable, "-c", load], input=pickle.dumps(value), cwd=tmp_path, env={"PATH": os.environ["PATH"]}, check=True)
    assert sent
