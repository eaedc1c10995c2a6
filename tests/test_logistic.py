import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabweave.operators import logistic as L
from tabweave.operators import models as G


def rows_of(spark, n=400, weights=(1.5, -0.02), seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x = (rng.gauss(1, 1), rng.gauss(50, 40))
        p = 1 / (1 + math.exp(-(0.4 + sum(w * v for w, v in zip(weights, x)))))
        out.append((i, *x, float(rng.random() < p)))
    return spark.createDataFrame(out, "id long, a double, b double, y double")


@pytest.mark.parametrize("scale", [True, False])
def test_newton_finds_the_minimum_that_spark_finds(spark, monkeypatch, scale):
    rows = rows_of(spark)
    want = G.train(rows, ["a", "b"], "y", "logistic_regression", scale=scale, C=0.05, tol=1e-12).model.stages[-1]
    monkeypatch.setattr(L, "NEWTON_FROM", 1)
    t = G.train(rows, ["a", "b"], "y", "logistic_regression", scale=scale, C=0.05, keep=False)
    got = t.model.stages[-1]
    assert not got.hasSummary and got.numClasses == 2
    assert np.allclose([*got.coefficients, got.intercept], [*want.coefficients, want.intercept], rtol=1e-5, atol=1e-7)
    both = t.score(rows, ["y"]).agg(F.count("*"), F.max(F.abs(F.col("p0") + F.col("p1") - 1))).first()
    assert both[0] == 400 and both[1] < 1e-12


def test_what_newton_does_not_serve_goes_to_spark(spark, monkeypatch):
    monkeypatch.setattr(L, "NEWTON_FROM", 1)
    rows = rows_of(spark, 60)
    fit = lambda df, **p: G.train(df, ["a", "b"], "y", "logistic_regression", **p).model.stages[-1]
    assert fit(rows, elasticNetParam=0.5).hasSummary and fit(rows, fitIntercept=False).hasSummary
    assert fit(rows.withColumn("y", F.col("id") % 3)).numClasses == 3
    # One class only, and classes that a line parts without a penalty: no minimum to find.
    assert fit(rows.withColumn("y", F.lit(1.0))).hasSummary
    assert fit(rows.withColumn("y", (F.col("a") > 1).cast("double")), regParam=0.0, maxIter=20).hasSummary
    with pytest.raises(Exception, match="(?i)null"):
        fit(rows.withColumn("a", F.when(F.col("id") > 0, F.col("a"))), scale=False)


def test_a_step_too_far_is_halved():
    # sqrt(1 + x^2): from beyond 1 Newton's full step leads away from the minimum.
    sums = lambda w: (float(np.sqrt(1 + w @ w)), w / np.sqrt(1 + w @ w), np.eye(1) / (1 + w @ w) ** 1.5)
    assert abs(L._minimum(sums, np.array([3.0]), 1e-9, 60)[0]) < 1e-4
