"""Forecasts against a plain recursion, and that no later value reaches them."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tabweave.operators import forecasting as S

START = datetime(2024, 1, 1)


def series_rows(days=40):
    rows = []
    for k, slope in (("a", 2.0), ("b", -1.0), (None, 0.5)):
        for d in range(days):
            if k == "b" and d % 9 == 4:
                continue
            # Two rows a day, which are summed.
            v = 10 + slope * d + 3 * math.sin(d / 2)
            rows += [(k, START + timedelta(days=d, hours=5), v / 2, 1.0), (k, START + timedelta(days=d, hours=9), v / 2, 2.0)]
    return rows


@pytest.fixture(scope="module")
def daily(spark):
    return spark.createDataFrame(series_rows(), "k string, t timestamp_ntz, v double, lag_1 double").cache()


LINEAR = {"kind": "linear_regression", "lags": (1, 3), "windows": (4,)}


def test_steps_equal_a_plain_recursion(daily):
    f = S.fit_forecaster(daily, "k", "t", "v", cutoff=S_INDEX + 30, **LINEAR)
    got = {(r.k, r.step): (r.period, r.prediction) for r in f.ahead(daily, "5 days", S_INDEX + 30).collect()}
    assert len(got) == 15
    line = f.model.model.stages[-1]
    fills = f.model.preparation.steps[0].values
    for k in ("a", "b", None):
        known = {}
        for key, t, v, _ in series_rows():
            if key == k and t <= START + timedelta(days=31):
                known[(t - START).days] = known.get((t - START).days, 0.0) + v
        for step in range(1, 6):
            d = 30 + step
            near = [known[x] for x in range(d - 4, d) if x in known]
            made = {"lag_1": known.get(d - 1), "lag_3": known.get(d - 3), "mean_4": sum(near) / len(near)}
            at = START + timedelta(days=d)
            made |= {"month": at.month, "weekday": at.weekday()}
            x = [fills[c] if made[c] is None else made[c] for c in f.model.features]
            known[d] = line.intercept + sum(w * v for w, v in zip(line.coefficients, x))
            assert got[k, step][0] == at and got[k, step][1] == pytest.approx(known[d])


#: Number of START's day.
S_INDEX = (START - datetime(1970, 1, 1)).days


def test_values_after_the_cutoff_change_nothing(daily):
    late = F.col("t") >= F.lit((START + timedelta(days=33)).isoformat()).cast("timestamp_ntz")
    other = daily.withColumn("v", F.when(late, F.col("v") * 100 - 7).otherwise(F.col("v")))
    one, two = (S.rolling(d, "k", "t", "v", horizon=7, folds=1, **LINEAR).orderBy("k", "step").collect() for d in (daily, other))
    assert [(r.k, r.step, r.prediction) for r in one] == [(r.k, r.step, r.prediction) for r in two]
    assert {r.step for r in one} == set(range(1, 8)) and [r.y for r in one] != [r.y for r in two]


def test_folds_step_back_by_a_horizon(daily):
    out = S.rolling(daily, "k", "t", "v", horizon="1 week", folds=9, **LINEAR)
    bounds = {r.fold: (r.low, r.high) for r in out.groupBy("fold").agg(F.min("period").alias("low"), F.max("period").alias("high")).collect()}
    # Forty days hold five horizons with something before them.
    assert set(bounds) == {1, 2, 3, 4, 5}
    assert bounds[2] == (START + timedelta(days=26), START + timedelta(days=32))
    with pytest.raises(ValueError):
        S.rolling(daily, "k", "t", "v", horizon=40, folds=1, **LINEAR)


def test_beyond_the_table_and_hours(daily, spark):
    ahead = S.fit_forecaster(daily, "k", "t", "v", **LINEAR).ahead(daily, 3)
    assert ahead.agg(F.min("period"), F.max("period"), F.count("prediction")).first()[:] == (START + timedelta(days=40), START + timedelta(days=42), 9)
    hours = spark.createDataFrame([("x", START + timedelta(hours=h), float(h)) for h in range(60)], "k string, t timestamp_ntz, v double")
    said = S.fit_forecaster(hours, "k", "t", "v", "hour", kind="linear_regression", lags=(1,), windows=()).ahead(hours, "2 hours").orderBy("step").collect()
    assert [r.period for r in said] == [START + timedelta(hours=60), START + timedelta(hours=61)]
    assert said[1].prediction == pytest.approx(61, abs=0.5)
    none = S.fit_forecaster(daily, "k", "t", "v", **LINEAR).ahead(daily.limit(0), 3)
    assert none.count() == 0 and none.columns == ahead.columns
    for bad in ("3 years", 0):
        with pytest.raises(ValueError):
            S.periods_in(bad, "day")
    with pytest.raises(ValueError):
        S.period_index(F.col("t"), "week")
