"""Queries over training. Trained numbers cannot equal another engine's, so what SQL can
check is checked: row counts of the parts, closed forms, and conditions at the optimum."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabweave.catalog.base import LINE_KEY, hash_sql, query, rounded, scored_lines, table
from tabweave.catalog.splits import _QUOTAS
from tabweave.config import SearchConfig
from tabweave.operators import forecasting as S
from tabweave.operators import metrics as M
from tabweave.operators import models as G
from tabweave.operators import scoring as P
from tabweave.operators.search import Candidate, on_rung, ranking, sample_candidates, search, successive_halving
from tabweave.operators.split import split_by_bucket, split_stratified, stratified_folds
from tabweave.session import fresh_dir, written
from tabweave.sources.writers import write_splits

# All models are trained with the library's defaults: 100 trees of depth 10, 100 rounds, five folds.
_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
FOLDS = 5


def _lines(spark, sf):
    rows = scored_lines(spark, sf)
    return rows.select(*LINE_KEY, *_FEATS, F.col("label").cast("double").alias("label"))


@query(
    """WITH m AS (SELECT regr_slope(value, user_id) AS b, regr_intercept(value, user_id) AS a FROM events)
       SELECT event_id, round(a + b * user_id, 6) AS prediction FROM events, m"""
)
def linear_regression(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", "value")
    t = G.train(rows, ["user_id"], "value", "linear_regression", "regression")
    return rounded(t.score(rows, ["event_id"]), "prediction")


_TEST_COUNTS = f"""WITH l AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1.0::double ELSE 0.0::double END AS label FROM lineitem),
  {_QUOTAS.format("label", "l")} SELECT cls AS label, k::bigint AS n, true AS sums_to_one, true AS in_range FROM quota"""


def _held_out(spark, sf, kind, **params):
    """Train on 80 %, score the held-out rows: rows per class and sanity of the probabilities."""
    path = fresh_dir(spark, "splits")
    # Both parts are written once, so that training and scoring do not compute the split again.
    write_splits(split_stratified(_lines(spark, sf), LINE_KEY, "label", 0.2), path)
    rows = spark.read.parquet(path)
    t = G.train(rows.where("split = 'train'").drop("split"), _FEATS, "label", kind, **params)
    out = t.score(rows.where("split = 'test'"), ["label"])
    fair = F.max(F.abs(F.col("p0") + F.col("p1") - 1)) < 1e-9
    return out.groupBy("label").agg(
        F.count("*").alias("n"), fair.alias("sums_to_one"), F.every(F.col("p1").between(0, 1)).alias("in_range")
    )


@query(_TEST_COUNTS)
def forest_classifier(spark, sf):
    return _held_out(spark, sf, "random_forest")


@query(_TEST_COUNTS)
def boosted_classifier(spark, sf):
    return _held_out(spark, sf, "gradient_boosting")


@query("SELECT count(*) AS n, true AS optimal FROM lineitem")
def logistic_classifier(spark, sf):
    """Scaled features and L2: at the optimum the gradient of the penalised loss is zero."""
    rows = _lines(spark, sf)
    t = G.train(rows, _FEATS, "label", "logistic_regression", tol=1e-10)
    lr = t.model.stages[-1]
    weights = lr.coefficients.toArray()
    out = t.transform(rows)
    p = G.vector_to_array("probability")[1]
    x = G.vector_to_array("features")
    grads = [
        F.avg((p - F.col("label")) * x[j]) + F.lit(float(lr.getRegParam() * w)) for j, w in enumerate(weights)
    ]
    steep = F.greatest(F.abs(F.avg(p - F.col("label"))), *[F.abs(g) for g in grads])
    return out.agg(F.count("*").alias("n"), (steep < 1e-4).alias("optimal"))


def _better_than_mean(spark, sf, kind, **params):
    rows = table(spark, sf, "lineitem").select(*LINE_KEY, "l_quantity", "l_discount", "l_tax", "l_extendedprice")
    t = G.train(rows, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", kind, "regression", **params)
    out = M.regression_metrics(t.score(rows, [*LINE_KEY, "l_extendedprice"]), "l_extendedprice", "prediction")
    return out.select("n", (F.col("r2") > 0).alias("explains"))


@query("SELECT count(*) AS n, true AS explains FROM lineitem")
def forest_regressor(spark, sf):
    return _better_than_mean(spark, sf, "random_forest", maxDepth=10)


@query("SELECT count(*) AS n, true AS explains FROM lineitem")
def boosted_regressor(spark, sf):
    return _better_than_mean(spark, sf, "gradient_boosting")


def _classes(spark, sf):
    """orders with three text classes as coded labels."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")
    return G.numeric_label(rows.withColumn("y", F.col("o_orderstatus")), "y")


_CLASS_FEATS = ["o_totalprice", "o_custkey"]
_CLASS_SQL = "SELECT o_orderstatus, count(*) AS n, true AS sums_to_one, true AS likeliest FROM orders GROUP BY 1"


def _class_check(out):
    """Rows per class; probabilities of three classes sum to 1, and the prediction is the likeliest."""
    each = F.array("p0", "p1", "p2")
    total = F.max(F.abs(F.col("p0") + F.col("p1") + F.col("p2") - 1)) < 1e-9
    best = F.every(F.element_at(each, F.col("prediction").cast("int") + 1) == F.array_max(each))
    return out.groupBy("o_orderstatus").agg(F.count("*").alias("n"), total.alias("sums_to_one"), best.alias("likeliest"))


@query(_CLASS_SQL)
def boosted_multiclass(spark, sf):
    """Coded labels, trees of all classes grown together on the residuals of the softmax."""
    coded, _ = _classes(spark, sf)
    t = G.train(coded, _CLASS_FEATS, "y", "gradient_boosting")
    return _class_check(t.score(coded, ["o_orderstatus"]))


_REBATE_CLASS = "CASE WHEN l_quantity * l_discount > 2 THEN 'high' WHEN l_quantity > 25 THEN 'many' ELSE 'few' END"


@query(
    f"""WITH share AS (SELECT {_REBATE_CLASS} AS y, count(*) AS n, count(*) / sum(count(*)) OVER () AS s FROM lineitem GROUP BY 1)
        SELECT round((SELECT -sum(s * ln(s)) FROM share), 6)::double AS first_loss, 10::bigint AS rounds, true AS falls,
               (SELECT sum(n)::bigint FROM share) AS n, true AS beats_shares"""
)
def softmax_rounds(spark, sf):
    """Three classes of lineitem: the loss starts at the entropy of their shares and falls in each of ten rounds.

    Rows whose key hashes into a fifth are held out; their log loss lies below that entropy.
    """
    lines = table(spark, sf, "lineitem").select(*LINE_KEY, *_FEATS, F.expr(_REBATE_CLASS).alias("y"))
    rows, _ = G.numeric_label(lines, "y")
    losses = G.train(rows, _FEATS, "y", "gradient_boosting", maxIter=10).model.stages[-1].losses_by_round()
    falls = all(later < earlier for earlier, later in zip(losses, losses[1:]))
    parts = written(split_by_bucket(rows, LINE_KEY, 20), "parts")
    t = G.train(parts.where("split = 'train'").drop("split"), _FEATS, "y", "gradient_boosting", maxIter=10)
    scored = t.score(parts.where("split = 'test'"), ["y"])
    loss = F.avg(-F.log(F.element_at(F.array("p0", "p1", "p2"), F.col("y").cast("int") + 1)))
    first = F.round(F.lit(losses[0]), 6).alias("first_loss")
    told = [first, F.lit(len(losses)).cast("bigint").alias("rounds"), F.lit(falls).alias("falls")]
    counted = rows.agg(F.count("*").alias("n"))
    return counted.crossJoin(scored.agg((loss < losses[0]).alias("beats_shares"))).select(*told, "n", "beats_shares")


@query(_CLASS_SQL)
def vote_multiclass(spark, sf):
    coded, _ = _classes(spark, sf)
    models = [G.train(coded, _CLASS_FEATS, "y", k, scale=False) for k in ("random_forest", "logistic_regression")]
    return _class_check(G.vote(models, coded, ["o_orderstatus"]))


@query("SELECT count(*) AS n, true AS sums_to_one, true AS same FROM orders")
def proba_shapes(spark, sf):
    """Probabilities where a model has them, else its prediction."""
    coded, _ = _classes(spark, sf)
    forest = G.train(coded, _CLASS_FEATS, "y", "random_forest").model
    line = G.train(coded, ["o_totalprice"], "o_custkey", "linear_regression", "regression").model
    with_p = P.predict_proba(forest, coded, ["o_orderkey", *_CLASS_FEATS])
    both = P.proba_or_predict(line, with_p, ["o_orderkey", *_CLASS_FEATS, "p0", "p1", "p2"])
    again = P.proba_or_predict(forest, both.drop("prediction").withColumnsRenamed({f"p{c}": f"q{c}" for c in range(3)}), ["o_totalprice", "q0", "q1", "q2"])
    total = F.max(F.abs(F.col("p0") + F.col("p1") + F.col("p2") - 1)) < 1e-9
    same = F.every((F.col("p0") == F.col("q0")) & (F.col("p1") == F.col("q1")) & (F.col("p2") == F.col("q2")))
    return again.agg(F.count("*").alias("n"), total.alias("sums_to_one"), same.alias("same"))


_AUTO = (
    "WITH l AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1.0::double ELSE 0.0::double END AS label FROM orders) "
    "SELECT label, count(*) AS n FROM l GROUP BY 1"
)


@query(_AUTO)
def auto_boosted(spark, sf):
    """Automatic features, max-abs scaling, boosted trees."""
    y = (F.col("o_orderstatus") == "F").cast("double")
    rows = table(spark, sf, "orders").withColumn("label", y).drop("o_orderstatus")
    t = G.boosted_after_auto(rows, "label", ["o_orderkey"])
    return t.score(rows, ["label"]).where(F.col("p1").between(0, 1)).groupBy("label").agg(F.count("*").alias("n"))


def _searched(spark, sf, **judge):
    cfg = SearchConfig(primary_metric="AUC_weighted", blocked=("gradient_boosting",), timeout_minutes=60, **judge)
    rows = _lines(spark, sf)
    return rows, search(rows, LINE_KEY, _FEATS, "label", cfg)


@query(
    """SELECT count(*) AS n_rows, 'logistic_regression,random_forest' AS models, true AS ordered, true AS in_range, true AS recomputed,
       true AS best_registered FROM lineitem"""
)
def model_leaderboard(spark, sf):
    """The allowed candidates judged on five stratified folds, best first; one value is computed again from its scores."""
    rows, found = _searched(spark, sf, folds=FOLDS)
    board = [tuple(r) for r in ranking(found.leaderboard, "AUC_weighted").select("model", "value").collect()]
    folds = stratified_folds(rows, LINE_KEY, "label", FOLDS)
    out = G.out_of_fold(folds, LINE_KEY, _FEATS, "label", "logistic_regression", "classification", "fold", FOLDS)
    auc = M.auc_weighted(out, "label", {0: "p0", 1: "p1"}).first()[0]
    values = [v for _, v in board]
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.lit(",".join(sorted(m for m, _ in board))).alias("models"),
        F.lit(values == sorted(values, reverse=True)).alias("ordered"),
        F.lit(all(0 <= v <= 1 for v in values)).alias("in_range"),
        F.lit(abs(dict(board)["logistic_regression"] - auc) < 1e-9).alias("recomputed"),
        F.lit(found.best.name == board[0][0] == found.model.kind).alias("best_registered"),
    )


@query("SELECT count(*) AS n_rows, 'logistic_regression,random_forest' AS models, true AS in_range FROM lineitem")
def validated_search(spark, sf):
    """The same on a validation part instead of folds."""
    rows, found = _searched(spark, sf, validation_size=0.25)
    board = ranking(found.leaderboard, "AUC_weighted").collect()
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.lit(",".join(sorted(r["model"] for r in board))).alias("models"),
        F.lit(all(0 <= r["value"] <= 1 for r in board)).alias("in_range"),
    )


_RUNG_HASH = hash_sql(*LINE_KEY)


@query(
    f"""WITH h AS (SELECT {_RUNG_HASH} % 1048576 AS a, {_RUNG_HASH.replace("'42'", "'43'")} % 1048576 AS b FROM lineitem),
       r AS (SELECT * FROM (VALUES (0, 24, ceil(1048576 / 9.0)), (1, 8, ceil(1048576 / 3.0)), (2, 2, 1048576)) v(rung, candidates, cut))
       SELECT rung, candidates::bigint AS candidates, count(*) FILTER (WHERE b >= 262144) AS n_train, count(*) FILTER (WHERE b < 262144) AS n_test,
              true AS best_went_on, true AS recomputed FROM r JOIN h ON a < cut GROUP BY rung, candidates"""
)
def halving_leaderboard(spark, sf):
    """24 parameter samples on nested shares of the lines: 24, 8 and 2 of them; the best value of a rung is computed again."""
    rows = _lines(spark, sf)
    spaces = {"logistic_regression": {"C": (1e-4, 1e2)}, "random_forest": {"numTrees": [3, 5, 10], "maxDepth": [2, 4, 6]}}
    cfg = SearchConfig(primary_metric="AUC_weighted", validation_size=0.25, parallel_trials=4)
    todo = sample_candidates(24, ["random_forest", "logistic_regression", "random_forest"], spaces=spaces)
    found = successive_halving(rows, LINE_KEY, _FEATS, "label", cfg, todo, rungs=3, keep=3)
    board = found.rungs
    rung = board.where("rung = 1").orderBy(F.desc("value"), "model").first()
    again = next(c for c in todo if c.name == rung["model"])
    part = rows.where(on_rung(LINE_KEY, rung["share"])).withColumn("held", on_rung(LINE_KEY, 0.25, 43))
    t = G.train(part.where("NOT held").drop("held"), _FEATS, "label", again.kind, **again.params)
    auc = M.auc_weighted(t.score(part.where("held"), ["label"]), "label", {0: "p0", 1: "p1"}).first()[0]
    worst = F.min(F.when(F.col("went_on"), F.col("value"))) >= F.coalesce(F.max(F.when(~F.col("went_on"), F.col("value"))), F.lit(0.0))
    return board.groupBy("rung").agg(
        F.count("*").alias("candidates"),
        F.max("n_train").alias("n_train"),
        F.max("n_test").alias("n_test"),
        worst.alias("best_went_on"),
        F.lit(abs(auc - rung["value"]) < 1e-9).alias("recomputed"),
    )


@query("SELECT * FROM (VALUES ('logistic_regression', 'done', true), ('random_forest', 'cancelled', false)) v(model, status, has_value), (SELECT count(*) AS n_rows FROM lineitem)")
def search_limits(spark, sf):
    """A forest far too large for the limit of a trial is cancelled while it trains; the other candidate wins."""
    rows = _lines(spark, sf)
    todo = [Candidate("random_forest", "random_forest", {"numTrees": 3000, "maxDepth": 14}), Candidate("logistic_regression", "logistic_regression", {})]
    cfg = SearchConfig(primary_metric="AUC_weighted", validation_size=0.25, trial_timeout_minutes=0.75)
    board = ranking(search(rows, LINE_KEY, _FEATS, "label", cfg, todo).leaderboard, "AUC_weighted")
    n = rows.count()
    return board.select("model", "status", F.col("value").isNotNull().alias("has_value"), F.lit(n).cast("bigint").alias("n_rows"))


@query("SELECT (l_returnflag = 'R')::int::double AS label, count(*) AS n, count(*) AS n_in_range, count(*) AS n_decided FROM lineitem GROUP BY 1")
def out_of_fold(spark, sf):
    """Each row is predicted once, by a model that never saw its fold."""
    rows = stratified_folds(_lines(spark, sf), LINE_KEY, "label", FOLDS)
    out = G.out_of_fold(rows, LINE_KEY, _FEATS, "label", "random_forest", "classification", "fold", FOLDS)
    decided = (F.col("prediction") == 1) == (F.col("p1") > F.col("p0"))
    return out.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if(F.col("p1").between(0, 1)).alias("n_in_range"), F.count_if(decided).alias("n_decided")
    )


@query("SELECT count(*) AS n, true AS in_range, true AS averaged FROM lineitem")
def vote_ensemble(spark, sf):
    rows = _lines(spark, sf)
    models = [G.train(rows, _FEATS, "label", k) for k in ("random_forest", "gradient_boosting")]
    out = G.vote(models, rows, [*LINE_KEY, *_FEATS])
    singles = G.member_scores(models, out.drop("prediction"), [*LINE_KEY, *_FEATS, "p1"])
    gap = F.abs(F.col("p1") - (F.col("m0")[1] + F.col("m1")[1]) / 2)
    return singles.agg(
        F.count("*").alias("n"), F.every(F.col("p1").between(0, 1)).alias("in_range"), (F.max(gap) < 1e-12).alias("averaged")
    )


@query("SELECT count(*) AS n, true AS in_range FROM lineitem")
def stack_ensemble(spark, sf):
    rows = stratified_folds(_lines(spark, sf), LINE_KEY, "label", FOLDS)
    members = [("random_forest", {}), ("logistic_regression", {})]
    s = G.stack(rows, _FEATS, "label", members, "fold", FOLDS)
    out = s.score(rows.drop("fold"), LINE_KEY)
    return out.agg(F.count("*").alias("n"), F.every(F.col("p1").between(0, 1)).alias("in_range"))


@query("SELECT count(*) AS n, true AS same FROM orders")
def saved_model(spark, sf):
    """Save, load (which scores an example row), and compare the scores of both."""
    y = (F.col("o_orderstatus") == "F").cast("double")
    rows = table(spark, sf, "orders").withColumn("label", y).drop("o_orderstatus")
    prep = G.auto_features(rows, "label", ["o_orderkey"])
    feats = [c for c in prep.transform(rows).columns if c not in ("label", "o_orderkey")]
    t = G.train(rows, feats, "label", "logistic_regression", preparation=prep)
    path = fresh_dir(spark, "model")
    G.save_trained(t, path, rows)
    again = G.load_trained(spark, path)
    # The raw row travels along, so that the second model scores it right after the first: no join.
    first = t.score(rows.withColumn("raw", F.struct("*")), ["raw"]).select("raw.*", F.col("p1").alias("before"))
    both = again.score(first, ["before"])
    return both.agg(F.count("*").alias("n"), (F.max(F.abs(F.col("p1") - F.col("before"))) < 1e-12).alias("same"))


_DAYS_SQL = """WITH d AS (SELECT event_type, date_trunc('day', ts)::timestamp AS period, sum(value) AS v FROM events GROUP BY ALL),
    last AS (SELECT max(period) AS z FROM d)"""


@query(
    f"""{_DAYS_SQL}, mean AS (SELECT event_type, avg(v) AS m FROM d, last WHERE period <= z - INTERVAL 7 DAY GROUP BY 1)
       SELECT event_type, count(*) AS n, round(sum(v), 6) AS total, true AS in_range, true AS near_the_mean
       FROM d, last WHERE period > z - INTERVAL 7 DAY GROUP BY 1"""
)
def forecast_values(spark, sf):
    """Daily value per event type, boosted trees, seven days ahead of the cut-off: of the size of the days before it."""
    events = table(spark, sf, "events")
    _, scored = G.forecast(events, "event_type", "ts", "value")
    day = F.to_date("ts")
    last = events.agg(F.max(day)).first()[0]
    before = events.where(day <= F.date_sub(F.lit(last), 7)).groupBy("event_type", day.alias("d")).agg(F.sum("value").alias("v"))
    known = before.groupBy("event_type").agg(F.avg("v").alias("m"), F.min("v").alias("low"), F.max("v").alias("high"))
    fair = F.every(F.col("prediction").between(F.col("low") / 2, F.col("high") * 2))
    out = scored.join(known, "event_type").groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum("y").alias("total"), fair.alias("in_range"), (F.abs(F.avg("prediction") / F.first("m") - 1) < 0.5).alias("near_the_mean")
    )
    return rounded(out, "total")


def _running_totals(spark, sf):
    """Value of each event type summed up to each day: series with a trend, which their last values do not tell."""
    day = F.to_date("ts").cast("timestamp_ntz")
    days = table(spark, sf, "events").groupBy("event_type", day.alias("day")).agg(F.sum("value").alias("v"))
    return days.withColumn("total", F.sum("v").over(Window.partitionBy("event_type").orderBy("day"))).select("event_type", "day", "total")


_TOTALS_SQL = f"""{_DAYS_SQL}, t AS (SELECT event_type, period, sum(v) OVER (PARTITION BY event_type ORDER BY period) AS total FROM d)"""


@query(
    f"""{_TOTALS_SQL}, f AS (SELECT unnest([1, 2, 3]) AS fold),
       c AS (SELECT fold, z - to_days(7 * fold) AS cut FROM f, last),
       b AS (SELECT fold, event_type, avg(total) AS m FROM t, c WHERE period <= cut AND period > cut - INTERVAL 7 DAY GROUP BY ALL)
       SELECT fold, count(*) AS n, round(avg(abs(total - m)), 4) + 0.0 AS mean_error, true AS below_a_third_of_it
       FROM t JOIN c ON period > cut AND period <= cut + INTERVAL 7 DAY JOIN b USING (fold, event_type) GROUP BY fold"""
)
def forecast_rolling(spark, sf):
    """Three cut-offs, seven days ahead from each; the last week's mean, computed in SQL, errs more than three times as much."""
    totals = _running_totals(spark, sf)
    said = written(S.rolling(totals, "event_type", "day", "total", folds=3, kind="linear_regression", lags=(1, 2), windows=()), "rolling")
    last = totals.agg(F.max("day")).first()[0]
    cut = F.date_sub(F.lit(last.date()), 7 * F.col("fold"))
    weeks = totals.join(F.broadcast(spark.createDataFrame([(i,) for i in (1, 2, 3)], "fold int")), F.to_date("day").between(F.date_sub(cut, 6), cut))
    means = weeks.groupBy("fold", "event_type").agg(F.avg("total").alias("m"))
    out = said.join(means, ["fold", "event_type"]).groupBy("fold").agg(
        F.count("*").alias("n"),
        (F.round(F.avg(F.abs(F.col("y") - F.col("m"))), 4) + 0.0).alias("mean_error"),
        (F.avg(F.abs(F.col("y") - F.col("prediction"))) * 3 < F.avg(F.abs(F.col("y") - F.col("m")))).alias("below_a_third_of_it"),
    )
    return out


@query(
    f"""{_TOTALS_SQL}, s AS (SELECT unnest(range(1, 15)) AS step), e AS (SELECT event_type, max(total) AS newest FROM t GROUP BY 1)
       SELECT event_type, step::int AS step, z + to_days(step::int) AS period, true AS above_the_newest FROM e, s, last"""
)
def forecast_future(spark, sf):
    """Fourteen days beyond the table, each built on the forecasts before it: totals go on to grow."""
    totals = _running_totals(spark, sf)
    said = S.fit_forecaster(totals, "event_type", "day", "total", kind="linear_regression", lags=(1, 2), windows=()).ahead(totals, 14)
    newest = totals.groupBy("event_type").agg(F.max("total").alias("newest"))
    return said.join(newest, "event_type").select("event_type", "step", "period", (F.col("prediction") > F.col("newest")).alias("above_the_newest"))
