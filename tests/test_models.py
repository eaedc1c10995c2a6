import numpy as np
import pytest
from pyspark.sql import functions as F

from tabweave.config import SearchConfig
from tabweave.operators import models as G
from tabweave.operators.scoring import predict_proba, proba_or_predict
from tabweave.operators.search import Candidate, choose, default_candidates, on_rung, ranking, sample_candidates, search, successive_halving
from tabweave.sources.readers import synthetic


@pytest.fixture(scope="module")
def rows(spark):
    return synthetic(spark, 400, 4).withColumnRenamed("target", "label").cache()


FEATS = ["age", "bmi", "blood_pressure", "cholesterol"]
SMALL = {"numTrees": 4, "maxDepth": 3}


def test_dialects_on_edge_rows(frame):
    df = frame(
        [(1, None, 1.0, True, 0), (2, "b", None, None, 1), (3, "a", 5.0, False, 1)], "id int, k string, v double, f boolean, y int"
    )
    got = {d: [tuple(r)[1:4] for r in G.fit_dialect(df, d, "y", "id").transform(df).orderBy("id").collect()] for d in "abcde"}
    assert got["a"] == [(0.0, 1.0, 1.0), (2.0, 3.0, None), (1.0, 5.0, 0.0)] or got["a"][1][2] in (None, 0.5)
    assert got["b"] == [(0.0, 1.0, 2.0), (2.0, 3.0, 0.0), (1.0, 5.0, 1.0)]
    assert [r[0] for r in got["c"]] == [2.0, 1.0, 0.0] and got["c"][1][1] is None
    assert got["d"] == [(-1.0, 1.0, 1.0), (0.0, 0.0, 0.0), (1.0, 5.0, 0.0)]
    assert got["e"] == [(0.0, 1.0, 1.0), (2.0, 0.0, 0.0), (1.0, 5.0, 0.0)]
    with pytest.raises(ValueError):
        G.fit_dialect(df, "z", "y")
    with pytest.raises(ValueError):
        G.fit_dialect(df, "d", "y")


def test_linear_regression_equals_least_squares(spark):
    df = synthetic(spark, 300, 3, "regression").cache()
    names = ["age", "bmi", "blood_pressure"]
    t = G.train(df, names, "target", "linear_regression", "regression")
    pdf = df.toPandas()
    x = np.column_stack([np.ones(300), pdf[names]])
    want = np.linalg.lstsq(x, pdf["target"], rcond=None)[0]
    lr = t.model.stages[-1]
    assert [lr.intercept, *lr.coefficients] == pytest.approx(list(want))


@pytest.mark.parametrize("kind,params", [("random_forest", SMALL), ("gradient_boosting", {"maxIter": 3, "maxDepth": 2}), ("logistic_regression", {})])
def test_classifiers_learn(rows, kind, params):
    t = G.train(rows, FEATS, "label", kind, **params)
    out = t.score(rows, ["row_id", "label"])
    assert out.columns == ["row_id", "label", "prediction", "p0", "p1"]
    assert out.agg(F.avg((F.col("label") == F.col("prediction")).cast("int"))).first()[0] > 0.75


def test_unknown_model_or_task(rows):
    with pytest.raises(ValueError):
        G.train(rows, FEATS, "label", "svm")
    with pytest.raises(ValueError):
        G.train(rows, FEATS, "label", "random_forest", "ranking")


def test_text_label(frame):
    out, codes = G.numeric_label(frame([("b",), ("a",)], "y string"), "y")
    assert codes == {"a": 0, "b": 1} and [r[0] for r in out.collect()] == [1.0, 0.0]
    out, codes = G.numeric_label(frame([(True,)], "y boolean"), "y")
    assert codes is None and out.first()[0] == 1.0


def test_save_load(rows, spark, tmp_path):
    raw = rows.withColumn("k", F.when(F.col("age") > 0, "old").otherwise("young"))
    prep = G.auto_features(raw, "label", ["row_id"])
    feats = [c for c in prep.transform(raw).columns if c not in ("label", "row_id")]
    t = G.train(raw, feats, "label", "logistic_regression", preparation=prep)
    G.save_trained(t, str(tmp_path / "m"), raw)
    again = G.load_trained(spark, str(tmp_path / "m"))
    a = t.score(raw, ["row_id"]).orderBy("row_id").collect()
    assert a == again.score(raw, ["row_id"]).orderBy("row_id").collect()
    assert again.contract["k"].dataType.simpleString() == "string"
    assert spark.read.parquet(str(tmp_path / "m" / "example")).count() == 5


def test_probabilities(rows):
    t = G.train(rows, FEATS, "label", "random_forest", **SMALL)
    got = predict_proba(t.model, rows, ["row_id"])
    assert got.columns == ["row_id", "p0", "p1"]
    with pytest.raises(ValueError):
        predict_proba(t.model, rows, [], task="regression")
    r = G.train(rows, FEATS[:2], "cholesterol", "random_forest", "regression", **SMALL)
    assert proba_or_predict(r.model, rows, []).columns == ["prediction"]
    assert predict_proba(r.model, rows, []).columns == ["p0", "p1"]


def test_search(rows):
    cands = [Candidate("rf", "random_forest", SMALL), Candidate("lr", "logistic_regression", {}), Candidate("no", "gradient_boosting", {})]
    cfg = SearchConfig(folds=2, validation_size=0.2, blocked=("no",), primary_metric="accuracy", parallel_trials=2)
    found = search(rows, ["row_id"], FEATS, "label", cfg, cands)
    board = ranking(found.leaderboard, "accuracy").collect()
    assert len(board) == 2 and board[0]["model"] == found.best.name == "lr"
    assert {"auc_weighted", "f1_macro"} <= {r["metric"] for r in found.leaderboard.collect()}
    one = search(rows, ["row_id"], FEATS, "label", SearchConfig(validation_size=0.25, timeout_minutes=1e-9), cands)
    assert one.leaderboard.select("model").distinct().count() == 1
    reg = SearchConfig(task="regression", primary_metric="normalized_root_mean_squared_error", folds=2, allowed=("lr",))
    got = search(rows, ["row_id"], FEATS[:3], "cholesterol", reg, [Candidate("lr", "linear_regression", {})])
    assert {"rmse_normalised", "spearman", "r2"} <= {r["metric"] for r in got.leaderboard.collect()}
    with pytest.raises(ValueError):
        search(rows, ["row_id"], FEATS, "label", SearchConfig(primary_metric="zz"), cands)


def test_candidate_lists():
    every = default_candidates("classification")
    assert [c.name for c in choose(every, SearchConfig(allowed=("random_forest",)))] == ["random_forest"]
    assert len(choose(every, SearchConfig(max_trials=2))) == 2
    assert default_candidates("regression")[-1].kind == "linear_regression"


def test_series_features_on_a_gap(frame):
    df = frame(
        [("s", "2024-01-01 03:00:00", 1.0), ("s", "2024-01-01 05:00:00", 2.0), ("s", "2024-01-02 00:00:00", 5.0), ("s", "2024-01-04 00:00:00", 7.0)],
        "k string, t string, v double",
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))
    made = G.series_features(df, "k", "t", "v", lags=(1, 2), windows=(2,))
    got = [tuple(r)[2:] for r in made.orderBy("period").collect()]
    assert got == [(3.0, None, None, None), (5.0, 3.0, None, 3.0), (7.0, None, 5.0, 5.0)]
    parts = G.split_by_time(made, "period", "2 days").groupBy("split").count().collect()
    assert dict(map(tuple, parts)) == {"train": 2, "test": 1}


def test_hourly_series(frame):
    df = frame([("s", "2024-01-01 23:10:00", 1.0), ("s", "2024-01-02 00:20:00", 2.0)], "k string, t string, v double")
    made = G.series_features(df.withColumn("t", F.col("t").cast("timestamp_ntz")), "k", "t", "v", "hour", (1,), (2,))
    got = [(str(r["period"]), r["y"], r["lag_1"]) for r in made.orderBy("period").collect()]
    assert got == [("2024-01-01 23:00:00", 1.0, None), ("2024-01-02 00:00:00", 2.0, 1.0)]
    with pytest.raises(ValueError):
        G.series_features(df, "k", "t", "v", "week")


def test_forecast_scores_only_the_last_part(spark):
    day = F.make_dt_interval(days=(F.col("id") % 40).cast("int"))
    df = spark.range(400).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("k"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + day).alias("t"),
        (F.col("id") % 7).cast("double").alias("v"),
    )
    _, scored = G.forecast(df, "k", "t", "v", horizon="5 days", maxIter=2, maxDepth=2)
    assert scored.agg(F.min("period").cast("string")).first()[0] == "2024-02-05 00:00:00"
    assert scored.where("prediction IS NULL").count() == 0
    made = G.series_features(df, "k", "t", "v").na.fill(0)
    cfg = SearchConfig(task="forecasting", primary_metric="rmse")
    one = [Candidate("lr", "linear_regression", {})]
    found = search(made, ["k", "period"], ["lag_1", "mean_7"], "y", cfg, one, time_column="period")
    assert found.leaderboard.count() > 3
    with pytest.raises(ValueError):
        search(made, ["k", "period"], ["lag_1"], "y", cfg, one)


def test_stack_is_a_linear_model_on_scores_of_other_folds(rows):
    from tabweave.operators.split import stratified_folds

    members = [("gradient_boosting", {"maxIter": 3, "maxDepth": 2}), ("logistic_regression", {})]
    folded = stratified_folds(rows, ["row_id"], "label", 2).cache()
    s = G.stack(folded, FEATS, "label", members, "fold", 2)
    out = {r.row_id: r.p1 for r in s.score(rows, ["row_id"]).collect()}
    # By hand: level one from models that never saw the row, then the scaled linear model on the refitted members' scores.
    assert s.score(rows, ["row_id", "age"]).select("row_id", "age").exceptAll(rows.select("row_id", "age")).count() == 0
    folded = s.preparation.transform(folded).cache()
    parts = []
    for i in range(2):
        fitted = [G.train(folded.where(f"fold <> {i}"), FEATS, "label", k, scale=False, **p) for k, p in members]
        scored = G.member_scores(fitted, folded.where(f"fold = {i}"), ["row_id", "label"])
        parts += [(r.m0[1], r.m1[1], r.label) for r in scored.select("m0", "m1", "label").collect()]
    level1 = rows.sparkSession.createDataFrame([(float(a), float(b), float(c)) for a, b, c in parts], "m0_1 double, m1_1 double, label double")
    top = G.train(level1, ["m0_1", "m1_1"], "label", "logistic_regression")
    again = {r.row_id: r.p1 for r in G.Stack(s.base, top, s.preparation).score(rows, ["row_id"]).collect()}
    assert out.keys() == again.keys() and len(out) == 400
    assert max(abs(out[k] - again[k]) for k in out) < 1e-3
    truth = {r.row_id: r.label for r in rows.select("row_id", "label").collect()}
    assert np.mean([(out[k] > 0.5) == (truth[k] == 1) for k in out]) > 0.75


def test_a_trial_above_its_limit_is_cancelled(rows):
    import time

    import pandas as pd

    def judge(df, c):
        if c.name != "slow":
            return df.select("row_id", "label", F.col("label").cast("double").alias("prediction"))

        def sleep(batches):
            time.sleep(300)
            yield from batches

        return df.select("row_id", "label", F.lit(0.0).alias("prediction")).coalesce(1).mapInPandas(sleep, "row_id long, label long, prediction double")

    todo = [Candidate("slow", "logistic_regression", {}), Candidate("quick", "logistic_regression", {})]
    cfg = SearchConfig(primary_metric="accuracy", trial_timeout_minutes=0.5, parallel_trials=2)
    start = time.monotonic()
    found = search(rows, ["row_id"], FEATS, "label", cfg, todo, judge=judge)
    assert time.monotonic() - start < 200
    board = [tuple(r) for r in ranking(found.leaderboard, "accuracy").select("model", "value", "status").collect()]
    assert board == [("quick", 1.0, "done"), ("slow", None, "cancelled")] and found.best.name == "quick"
    with pytest.raises(TimeoutError):
        search(rows, ["row_id"], FEATS, "label", cfg, todo[:1], judge=judge)


def test_halving_promotes_the_best_of_nested_rungs(rows):
    todo = sample_candidates(6, ["logistic_regression", "random_forest"], spaces={"logistic_regression": {"C": (1e-3, 1e2)}, "random_forest": {"numTrees": [2, 3], "maxDepth": [2]}})
    assert todo == sample_candidates(6, ["logistic_regression", "random_forest"], spaces={"logistic_regression": {"C": (1e-3, 1e2)}, "random_forest": {"numTrees": [2, 3], "maxDepth": [2]}})
    cfg = SearchConfig(primary_metric="accuracy", parallel_trials=3)
    found = successive_halving(rows, ["row_id"], FEATS, "label", cfg, todo, rungs=2, keep=3)
    board = found.rungs.collect()
    assert [r.rung for r in board] == [0] * 6 + [1] * 2
    first = sorted((-r.value, r.model) for r in board if r.rung == 0)
    assert {m for _, m in first[:2]} == {r.model for r in board if r.rung == 1} == {r.model for r in board if r.rung == 0 and r.went_on}
    assert found.best.name == min((-r.value, r.model) for r in board if r.rung == 1)[1] and found.model.kind == found.best.kind
    sizes = {r.rung: (r.n_train, r.n_test) for r in board}
    assert sum(sizes[1]) == 400 and 80 < sum(sizes[0]) < 190
    small, large = (set(r.row_id for r in rows.where(on_rung(["row_id"], s)).collect()) for s in (1 / 3, 2 / 3))
    assert small < large
    with pytest.raises(ValueError):
        successive_halving(rows, ["row_id"], FEATS, "label", cfg, [], rungs=2)


def test_making_the_rows_is_no_part_of_a_trial(spark):
    import time

    import pandas as pd

    @F.pandas_udf("double")
    def slow(v: pd.Series) -> pd.Series:
        time.sleep(9)
        return v.astype(float)

    base = spark.range(40).select("id", (F.col("id") % 2).cast("double").alias("label")).coalesce(1)
    df = base.withColumn("x", slow("id"))

    def judge(rows, c):
        return rows.select("id", "label", F.col("label").alias("prediction"), (1 - F.col("label")).alias("p0"), (F.col("label") + 0 * F.col("x")).alias("p1"))

    todo = [Candidate("lr", "logistic_regression", {})]
    cfg = SearchConfig(primary_metric="AUC_weighted", trial_timeout_minutes=0.12)
    board = search(df, ["id"], ["x"], "label", cfg, todo, judge=judge).leaderboard
    assert {r["status"] for r in board.collect()} == {"done"}
