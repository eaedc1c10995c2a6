"""Logistic regression of long tables by Newton's method.

The penalised loss has one minimum, whatever finds it. A pass over the rows sums the loss, its gradient and its Hessian, which
is small where features are few; the next point follows from those, and a handful of passes end nearer to the minimum than
the dozens that gradients alone take. The sums are SQL, so that rows stay columns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark import SparkContext
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.functions.columns import quoted

#: Tables shorter than this, or with more features, are left to Spark; passes and halvings of a step until that is done too.
NEWTON_FROM, MOST_FEATURES, MOST_PASSES = 50_000, 12, 60


def fit_by_newton(estimator: LogisticRegression, rows: DataFrame, features: Sequence[str], label: str, n: int, classes: int) -> LogisticRegressionModel | None:
    """The estimator's model of all rows, or None where Newton's method does not serve: then Spark is to fit it."""
    if n < NEWTON_FROM or classes != 2 or not 0 < len(features) <= MOST_FEATURES or not _plain(estimator):
        return None
    x, y = [quoted(c) for c in features], quoted(label)
    odd = [c.isNull() | F.isnan(c) | (F.abs(c) == math.inf) for c in x] + [y.isNull() | ~y.isin(0.0, 1.0)]
    seen = rows.agg(F.sum(y).alias("ones"), *[F.count_if(c).alias(f"odd{i}") for i, c in enumerate(odd)]).first()
    if any(seen[f"odd{i}"] for i in range(len(odd))) or not 0 < seen["ones"] < n:
        return None
    penalty = np.array([0.0, *[estimator.getRegParam()] * len(x)])
    start = np.zeros(len(x) + 1)
    start[0] = math.log(seen["ones"] / (n - seen["ones"]))
    weights = _minimum(lambda w: _sums(rows, x, y, w, n, penalty), start, estimator.getTol(), min(estimator.getMaxIter(), MOST_PASSES))
    if weights is None:
        return None
    context = SparkContext._active_spark_context
    java = [_py2java(context, v) for v in (DenseMatrix(1, len(x), weights[1:].tolist(), True), Vectors.dense([float(weights[0])]))]
    model = LogisticRegressionModel(context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(estimator.uid, *java, 2, False))
    estimator._copyValues(model)._transfer_params_to_java()
    return model


def _plain(estimator: LogisticRegression) -> bool:
    """Whether the loss is that of all rows alike with a squared penalty on the weights as they are."""
    bounds = ("lowerBoundsOnCoefficients", "upperBoundsOnCoefficients", "lowerBoundsOnIntercepts", "upperBoundsOnIntercepts", "weightCol")
    squared = estimator.getElasticNetParam() == 0.0 and (estimator.getRegParam() == 0.0 or not estimator.getStandardization())
    return squared and estimator.getFitIntercept() and estimator.getFamily() in ("auto", "binomial") and not any(estimator.isSet(b) for b in bounds)


def _sums(rows: DataFrame, x: list[Column], y: Column, w: np.ndarray, n: int, penalty: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean loss with its penalty, gradient and Hessian at the weights w, the intercept first."""
    z = sum((F.lit(float(v)) * c for v, c in zip(w[1:], x)), F.lit(float(w[0])))
    made = rows.select(*[c.alias(f"_x{i}") for i, c in enumerate(x, 1)], y.alias("_y"), z.alias("_z"))
    made = made.withColumn("_p", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_z"))))
    one = [F.lit(1.0), *[F.col(f"_x{i}") for i in range(1, len(w))]]
    error, spread = F.col("_p") - F.col("_y"), F.col("_p") * (F.lit(1.0) - F.col("_p"))
    loss = F.log1p(F.exp(-F.abs("_z"))) + F.greatest("_z", F.lit(0.0)) - F.col("_y") * F.col("_z")
    pairs = [(i, j) for i in range(len(w)) for j in range(i + 1)]
    told = made.agg(F.sum(loss), *[F.sum(error * c) for c in one], *[F.sum(spread * one[i] * one[j]) for i, j in pairs]).first()
    values = np.array(told, float) / n
    hessian = np.diag(penalty)
    for (i, j), v in zip(pairs, values[1 + len(w) :]):
        hessian[i, j] += v
        hessian[j, i] = hessian[i, j]
    return values[0] + float(penalty @ (w * w)) / 2, values[1 : 1 + len(w)] + penalty * w, hessian


def _minimum(sums, w: np.ndarray, tol: float, passes: int) -> np.ndarray | None:
    """Where the convex loss is least, or None if that is not found: a step that does not lower the loss is halved."""
    base, step, least = w, np.zeros(len(w)), math.inf
    for _ in range(passes):
        loss, gradient, hessian = sums(w)
        if not math.isfinite(loss) or loss > least + 1e-12 * abs(least):
            step = step / 2
            w = base + step
            continue
        scale = np.sqrt(np.diag(hessian))
        if not (scale > 0).all() or np.linalg.cond(hessian / np.outer(scale, scale)) > 1e12:
            return None
        step = -np.linalg.solve(hessian / np.outer(scale, scale), gradient / scale) / scale
        base, least = w, loss
        w = base + step
        # What a step can still gain; the one after it would gain about the square of that.
        if -gradient @ step / 2 <= 1e-3 * tol * loss:
            return w
    return None
