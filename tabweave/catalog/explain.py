"""Queries over attributions and cohorts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tabweave.catalog.base import (
    INTERCEPT,
    LINE_KEY,
    SCORED_SQL,
    WEIGHTS,
    hash_sql,
    longs,
    query,
    rounded,
    scored_lines,
    table,
)
from tabweave.config import Bin, DateParts, FeatureConfig
from tabweave.functions.columns import linear_score, sigmoid
from tabweave.operators import cohorts as C
from tabweave.operators import explain as E
from tabweave.operators import models as G
from tabweave.operators.split import sample_n
from tabweave.plans.flow import prepare
from tabweave.session import fresh_dir

_KEYS = "l_orderkey, l_linenumber::bigint AS l_linenumber, l_partkey, l_suppkey"
_FEATS = list(WEIGHTS)

_PHI_SQL = (
    "mu AS (SELECT "
    + ", ".join(f"avg({f}) AS m_{f}" for f in _FEATS)
    + " FROM lineitem), phi AS (SELECT lineitem.*, "
    + ", ".join(f"({WEIGHTS[f]})::double * ({f} - m_{f}) AS phi_{f}" for f in _FEATS)
    + f", {INTERCEPT} + "
    + " + ".join(f"({WEIGHTS[f]})::double * m_{f}" for f in _FEATS)
    + " AS base_value FROM lineitem, mu), long AS ("
    + " UNION ALL ".join(
        f"SELECT {_KEYS}, '{f}' AS feature, {f} AS feature_value, phi_{f} AS shap, base_value FROM phi" for f in _FEATS
    )
    + ")"
)


def _attribution(spark, sf):
    lines = table(spark, sf, "lineitem")
    return E.linear_attribution(lines, LINE_KEY, WEIGHTS, INTERCEPT, E.background_means(lines, _FEATS))


def _six(df, *names):
    return longs(rounded(df, *names), "l_linenumber")


@query(
    f"""WITH {_PHI_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, feature, round(feature_value, 6) AS feature_value,
        round(shap, 6) + 0.0 AS shap, round(base_value, 6) AS base_value FROM long"""
)
def shap_linear(spark, sf):
    return _six(E.long_table(_attribution(spark, sf)), "feature_value", "shap", "base_value")


@query(
    f"""WITH {_PHI_SQL}, g AS (SELECT feature, avg(abs(shap)) AS m FROM long GROUP BY 1)
        SELECT row_number() OVER (ORDER BY m DESC, feature) AS rank, feature, round(m, 6) AS mean_abs_shap FROM g"""
)
def shap_importance(spark, sf):
    return longs(rounded(E.importance(_attribution(spark, sf)), "mean_abs_shap"), "rank")


@query(
    f"""WITH {_PHI_SQL} SELECT feature, round(avg(abs(shap)), 6) AS mean_abs_shap, round(stddev_pop(shap), 6) AS std_shap,
        abs(avg(shap)) < 1e-6 AS centred FROM long GROUP BY 1 ORDER BY 2 DESC LIMIT 3"""
)
def shap_stats(spark, sf):
    """The mean of linear attributions is zero up to rounding, so its sign is not compared."""
    out = E.stats_report(_attribution(spark, sf), top=3)
    centred = (F.abs("mean_shap") < 1e-6).alias("centred")
    return rounded(out.select("feature", "mean_abs_shap", "std_shap", centred), "mean_abs_shap", "std_shap")


@query(
    f"""WITH {_PHI_SQL}, ids AS (SELECT *, row_number() OVER () AS id FROM phi),
        l AS ({" UNION ALL ".join(f"SELECT id, {_KEYS}, base_value, '{f}' AS feature, {f} AS feature_value, phi_{f} AS shap FROM ids" for f in _FEATS)}),
        r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY abs(shap) DESC, feature) AS rank FROM l)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(base_value, 6) AS base_value, rank, feature, round(shap, 6) + 0.0 AS shap,
          feature_value FROM r WHERE rank <= 2
        UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(base_value, 6), 3, 'other', round(sum(shap), 6) + 0.0, NULL
          FROM r WHERE rank > 2 GROUP BY id, l_orderkey, l_linenumber, l_partkey, l_suppkey, base_value"""
)
def shap_waterfall(spark, sf):
    out = E.waterfall(_attribution(spark, sf), top=2)
    return longs(_six(out, "base_value", "shap"), "rank")


@query(
    f"""WITH {_PHI_SQL}, t AS (SELECT feature AS f FROM long GROUP BY 1 ORDER BY avg(abs(shap)) DESC, 1 LIMIT 1)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, feature, round(feature_value, 6) AS feature_value, round(shap, 6) + 0.0 AS shap
        FROM long JOIN t ON feature = f"""
)
def shap_dependence(spark, sf):
    a = _attribution(spark, sf)
    return _six(E.dependence(a, E.top_features(a, 1)), "feature_value", "shap")


@query(
    f"""WITH {_PHI_SQL}, g AS (SELECT feature, avg(abs(shap)) AS m, quantile_cont(shap, [0, 0.25, 0.5, 0.75, 1]) AS q FROM long GROUP BY 1)
        SELECT row_number() OVER (ORDER BY m DESC, feature) AS rank, feature, """
    + ", ".join(f"round(q[{i + 1}], 6) + 0.0 AS q{p}" for i, p in enumerate((0, 25, 50, 75, 100)))
    + " FROM g"
)
def shap_distribution(spark, sf):
    return longs(rounded(E.distribution(_attribution(spark, sf)), "q0", "q25", "q50", "q75", "q100"), "rank")


@query(
    f"""WITH {_PHI_SQL}, t AS (SELECT feature AS f FROM long GROUP BY 1 ORDER BY avg(abs(shap)) DESC, 1 LIMIT 2)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, feature, round(feature_value, 6) AS feature_value, round(shap, 6) + 0.0 AS shap
        FROM long JOIN t ON feature = f"""
)
def shap_beeswarm(spark, sf):
    return _six(E.beeswarm(_attribution(spark, sf), top=2), "feature_value", "shap")


@query(
    f"""WITH {_PHI_SQL}, f AS (SELECT * FROM phi ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 50)
        {" UNION ALL ".join(f"SELECT {_KEYS}, '{f}' AS feature, round({f}, 6) AS feature_value, round(phi_{f}, 6) + 0.0 AS shap, round(base_value, 6) AS base_value FROM f" for f in _FEATS)}"""
)
def shap_force(spark, sf):
    return _six(E.force_rows(_attribution(spark, sf), 50), "feature_value", "shap", "base_value")


@query("SELECT count(*) * 4 AS n, true AS additive FROM lineitem")
def shap_explain_all(spark, sf):
    """All report tables written in one call; the summary table is read back and checked."""
    paths = E.explain_all(_attribution(spark, sf), fresh_dir(spark, "explain"))
    values, points = spark.read.parquet(paths["values"]), spark.read.parquet(paths["summary"])
    phis = sum((F.col(f"phi_{f}") for f in _FEATS), F.col("base_value"))
    wrong = values.where(F.abs(phis - linear_score(WEIGHTS, INTERCEPT)) > 1e-9).limit(1).count()
    return points.agg(F.count("*").alias("n")).withColumn("additive", F.lit(wrong == 0))


# ------------------------------------------------------------- fitted models

_TREE_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _training_lines(spark, sf):
    rows = scored_lines(spark, sf)
    return rows.select(*LINE_KEY, *_TREE_FEATS, F.col("label").cast("double").alias("label"))


def _additive(a, scored, output):
    """Rows, and whether base + sum of phi equals the model output everywhere."""
    total = sum((a.phi(f) for f in a.features), F.col("base_value"))
    gap = F.max(F.abs(total - output))
    return scored.agg(F.count("*").alias("n"), (F.coalesce(gap, F.lit(0.0)) < 1e-9).alias("additive"))


@query("SELECT count(*) AS n, true AS additive FROM lineitem")
def tree_shap_forest(spark, sf):
    """Attributions of a forest for every line; the sum equals the predicted probability."""
    rows = _training_lines(spark, sf)
    t = G.train(rows, _TREE_FEATS, "label", "random_forest")
    out = t.score(rows, [*LINE_KEY, *_TREE_FEATS])
    a = E.tree_attribution(out, [*LINE_KEY, "p1"], _TREE_FEATS, t.model.stages[-1])
    return _additive(a, a.df, F.col("p1"))


@query("SELECT count(*) AS n, true AS additive FROM lineitem")
def tree_shap_boosted(spark, sf):
    """Attributions of boosted trees; sigmoid(2 x sum) equals the predicted probability."""
    rows = _training_lines(spark, sf)
    t = G.train(rows, _TREE_FEATS, "label", "gradient_boosting")
    out = t.score(rows, [*LINE_KEY, *_TREE_FEATS])
    a = E.tree_attribution(out, [*LINE_KEY, "p1"], _TREE_FEATS, t.model.stages[-1])
    total = sum((a.phi(f) for f in a.features), F.col("base_value"))
    gap = F.max(F.abs(sigmoid(2 * total) - F.col("p1")))
    return a.df.agg(F.count("*").alias("n"), (gap < 1e-9).alias("additive"))


_CORR = " UNION ALL ".join(f"SELECT '{f}' AS feature, abs(corr({f}, (l_quantity > 25)::int)) AS r FROM lineitem" for f in _TREE_FEATS)


@query(f"WITH c AS ({_CORR}) SELECT arg_max(feature, r) AS top, count(*) AS features, true AS sums_to_one, true AS none_negative FROM c")
def split_importances(spark, sf):
    """Of a label that follows one feature, this feature has the largest importance."""
    rows = _training_lines(spark, sf).withColumn("label", (F.col("l_quantity") > 25).cast("double"))
    t = G.train(rows, _TREE_FEATS, "label", "random_forest")
    v = F.col("importance")
    out = E.split_importances(t.model.stages[-1], _TREE_FEATS)
    return out.agg(
        F.max_by("feature", v).alias("top"),
        F.count("*").alias("features"),
        (F.abs(F.sum(v) - 1) < 1e-9).alias("sums_to_one"),
        (F.min(v) >= 0).alias("none_negative"),
    )


@query("SELECT o_orderstatus, count(*) AS n, true AS additive FROM orders GROUP BY 1")
def shap_positive_class(spark, sf):
    """Attributions of a forest for each of three classes; of the positive class they sum to its probability."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")
    coded, _ = G.numeric_label(rows.withColumn("y", F.col("o_orderstatus")), "y")
    features = ["o_totalprice", "o_custkey"]
    t = G.train(coded, features, "y", "random_forest")
    out = t.score(coded, ["o_orderkey", "o_orderstatus", *features])
    long = E.positive_class(E.class_attributions(t, out, ["o_orderkey", "o_orderstatus", "p1"], 3))
    each = long.groupBy("o_orderkey", "o_orderstatus", "p1").agg((F.max("base_value") + F.sum("shap")).alias("total"))
    fair = F.max(F.abs(F.col("total") - F.col("p1"))) < 1e-9
    return each.groupBy("o_orderstatus").agg(F.count("*").alias("n"), fair.alias("additive"))


_PART_W = {"p_size": 0.03, "p_retailprice": -0.002, "name_length": 0.5, "type_length": -0.1}
_PART_SQL = (
    f"""p AS (SELECT *, length(p_name) AS name_length, length(p_type) AS type_length FROM part),
        b AS (SELECT * FROM p ORDER BY {hash_sql("p_partkey")}, p_partkey LIMIT 100),
        m AS (SELECT """
    + ", ".join(f"avg({f}) AS m_{f}" for f in _PART_W)
    + " FROM b), phi AS (SELECT p_partkey, "
    + ", ".join(f"round({w} * ({f} - m_{f}), 6) + 0.0 AS phi_{f}" for f, w in _PART_W.items())
    + ", round(1.0 + "
    + " + ".join(f"{w} * m_{f}" for f, w in _PART_W.items())
    + ", 6) AS base_value FROM p, m)"
)


def _part_attribution(rows):
    a = E.kernel_attribution(
        rows,
        ["p_partkey"],
        list(_PART_W),
        sample_n(rows, ["p_partkey"], E.BACKGROUND_ROWS),
        lambda df: df.withColumn("score", linear_score(_PART_W, 1.0)),
    )
    phis = [f"phi_{f}" for f in _PART_W]
    return rounded(a.df.select("p_partkey", *phis, "base_value"), *phis, "base_value")


def _part_rows(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", "p_name", "p_type")
    return rows.withColumns({"name_length": F.length("p_name"), "type_length": F.length("p_type")}).drop("p_name", "p_type")


@query(f"WITH {_PART_SQL} SELECT * FROM phi")
def kernel_shap(spark, sf):
    """Model-agnostic attributions of a linear scorer over 100 background rows; its exact values are known."""
    return _part_attribution(_part_rows(spark, sf))


@query(
    """WITH m AS (SELECT avg(p_size) AS s FROM part) SELECT p_size::bigint AS p_size, count(*) AS n, round(min(0.03 * (p_size - s)), 6) + 0.0 AS low,
       round(max(0.03 * (p_size - s)), 6) + 0.0 AS high FROM part, m GROUP BY 1"""
)
def kernel_shap_repeated(spark, sf):
    """Many equal rows, and a feature that is the key too: each row keeps its own attribution."""
    rows = table(spark, sf, "part").select("p_size")
    # The mean of a linear scorer over all rows is its score at their mean, given as one background row.
    mean = rows.agg(F.avg("p_size").alias("p_size"))
    a = E.kernel_attribution(rows, ["p_size"], ["p_size"], mean, lambda df: df.withColumn("score", linear_score({"p_size": 0.03}, 1.0)))
    out = a.df.groupBy("p_size").agg(F.count("*").alias("n"), F.min("phi_p_size").alias("low"), F.max("phi_p_size").alias("high"))
    return longs(rounded(out, "low", "high"), "p_size")


# A scorer of twelve features with one product of two of them, whose exact attributions are known.
_WIDE_W = {
    "l_quantity": 0.02, "l_extendedprice": 0.00001, "l_discount": 3.0, "l_tax": -2.0, "l_linenumber": 0.1, "l_partkey": 0.0001, "l_suppkey": -0.001,
    "year": 0.05, "month": -0.03, "day": 0.01, "returned": 0.7, "open": -0.4,
}
_WIDE_PAIR = 0.5
_WIDE_LINES = """p AS (SELECT *, year(l_shipdate) AS year, month(l_shipdate) AS month, day(l_shipdate) AS day,
    (l_returnflag = 'R')::int AS returned, (l_linestatus = 'O')::int AS open FROM lineitem)"""
_WIDE_SQL = (
    f"""WITH {_WIDE_LINES}, b AS (SELECT * FROM p ORDER BY {hash_sql(*LINE_KEY)}, {", ".join(LINE_KEY)} LIMIT 100),
        m AS (SELECT avg(l_quantity * l_tax) AS pair, """
    + ", ".join(f"avg({f}) AS m_{f}" for f in _WIDE_W)
    + f" FROM b) SELECT {', '.join(LINE_KEY)}, "
    + ", ".join(
        f"round({w} * ({f} - m_{f})"
        + {
            "l_quantity": f" + {_WIDE_PAIR / 2} * (l_quantity * m_l_tax - pair + l_quantity * l_tax - m_l_quantity * l_tax)",
            "l_tax": f" + {_WIDE_PAIR / 2} * (l_tax * m_l_quantity - pair + l_quantity * l_tax - m_l_tax * l_quantity)",
        }.get(f, "")
        + f", 6) + 0.0 AS phi_{f}"
        for f, w in _WIDE_W.items()
    )
    + " FROM p, m"
)


def _wide_score(x):
    """The scorer in array form: rows x features to scores."""
    return x @ np.array(list(_WIDE_W.values())) + _WIDE_PAIR * x[:, 0] * x[:, 3]


@query(_WIDE_SQL)
def kernel_shap_wide(spark, sf):
    """Twelve features and 100 background rows for every line, scored in arrays; products of two are exact under paired coalitions."""
    day = F.col("l_shipdate")
    made = {"year": F.year(day), "month": F.month(day), "day": F.day(day)}
    flags = {"returned": (F.col("l_returnflag") == "R").cast("int"), "open": (F.col("l_linestatus") == "O").cast("int")}
    rows = table(spark, sf, "lineitem").withColumns({**made, **flags})
    background = sample_n(rows, LINE_KEY, E.BACKGROUND_ROWS)
    a = E.array_attribution(rows, LINE_KEY, list(_WIDE_W), background, _wide_score, method="sampled", coalitions=32)
    phis = [f"phi_{f}" for f in _WIDE_W]
    return rounded(a.df.select(*LINE_KEY, *phis), *phis)


# -------------------------------------------------------------------- cohorts


def _cohort_lines(spark, sf):
    size = F.when(F.col("l_quantity") <= 10, "small").when(F.col("l_quantity") <= 30, "medium").otherwise("large")
    return scored_lines(spark, sf).withColumn("size", size)


_COHORT_SQL = f"""{SCORED_SQL}, cohort AS (SELECT *, CASE WHEN l_quantity <= 10 THEN 'small' WHEN l_quantity <= 30 THEN 'medium' ELSE 'large' END AS size FROM scored)"""


@query(
    f"""WITH {_COHORT_SQL} SELECT size, l_linestatus, 2 - grouping(size) - grouping(l_linestatus) AS level, count(*) AS n,
        sum((label <> prediction)::int)::bigint AS errors, round(avg((label <> prediction)::int), 6) AS error_rate,
        round(sum((label <> prediction)::int) / (SELECT sum((label <> prediction)::int) FROM cohort), 6)::double AS coverage
        FROM cohort GROUP BY CUBE (size, l_linestatus)"""
)
def error_cube(spark, sf):
    rows = _cohort_lines(spark, sf)
    out = C.error_cube(rows, F.col("label") != F.col("prediction"), ["size", "l_linestatus"])
    return longs(rounded(out, "error_rate", "coverage"), "level")


_SLICE_CELLS = {
    "size": "CASE WHEN l_quantity <= 10 THEN 'small' WHEN l_quantity <= 30 THEN 'medium' ELSE 'large' END",
    "rebate": "CASE WHEN l_discount <= 0.02 THEN 'low' WHEN l_discount <= 0.06 THEN 'middle' ELSE 'high' END",
    "taxed": "CASE WHEN l_tax <= 0.03 THEN 'low' ELSE 'high' END",
    "status": "l_linestatus",
}
_EFFECT = """SELECT *, e / n AS r, (e_all - e) / nullif(n_all - n, 0) AS o, sqrt((r * (1 - r) + o * (1 - o)) / 2) AS d,
  CASE WHEN d > 0 THEN (r - o) / d WHEN r > o THEN 'Infinity'::double ELSE 0 END AS effect FROM {0}, t WHERE n >= 0.01 * n_all"""
_ONE = "SELECT {0} AS f, {1} AS v, '`{1}` = ' || chr(39) || {1} || chr(39) AS slice, count(*) AS n, sum(wrong) AS e FROM c GROUP BY {1}"
_TWO = """SELECT a.slice || ' AND ' || b.slice AS slice, count(*) AS n, sum(wrong) AS e FROM c
  JOIN j1 a ON a.f = {0} AND a.v = c.{1} AND a.effect < 0.03 JOIN j1 b ON b.f = {2} AND b.v = c.{3} AND b.effect < 0.03 GROUP BY ALL"""
_TOLD = "SELECT slice, {0}::bigint AS level, n, e::bigint AS errors, round(r, 6) AS error_rate, round(effect, 6) AS effect FROM j{0} WHERE effect >= 0.03"
_ONES = " UNION ALL ".join(_ONE.format(i, k) for i, k in enumerate(_SLICE_CELLS))
_TWOS = " UNION ALL ".join(_TWO.format(i, k, j, m) for i, k in enumerate(_SLICE_CELLS) for j, m in enumerate(_SLICE_CELLS) if i < j)


@query(
    f"""WITH {SCORED_SQL}, c AS (SELECT {", ".join(f"{v} AS {k}" for k, v in _SLICE_CELLS.items())}, (label <> prediction)::int AS wrong FROM scored),
        t AS (SELECT count(*) AS n_all, sum(wrong) AS e_all FROM c), one AS ({_ONES}), j1 AS ({_EFFECT.format("one")}),
        two AS ({_TWOS}), j2 AS ({_EFFECT.format("two")})
        {_TOLD.format(1)} UNION ALL {_TOLD.format(2)}"""
)
def error_slices(spark, sf):
    """Slices of up to two conditions on which the scorer errs more often than elsewhere."""
    rows = scored_lines(spark, sf)
    cells = rows.select((F.col("label") != F.col("prediction")).alias("wrong"), *[F.expr(v).alias(k) for k, v in _SLICE_CELLS.items()])
    out = C.find_slices(cells, F.col("wrong"), list(_SLICE_CELLS), min_share=0.01, min_effect=0.03)
    return longs(rounded(out, "error_rate", "effect"), "level")


@query(f"WITH {SCORED_SQL} SELECT count(*) AS n, sum((label <> prediction)::int)::bigint AS errors, true AS as_told FROM scored")
def error_tree(spark, sf):
    """The rule of each cohort put to the rows: the cohorts hold every row once, as many and as wrong as the tree says."""
    rows = scored_lines(spark, sf)
    wrong = F.col("label") != F.col("prediction")
    tree = C.error_tree(rows, wrong, _TREE_FEATS).collect()
    held = [F.expr(r["cohort"]) for r in tree]
    counts = rows.agg(
        F.array(*[F.count_if(h) for h in held]).alias("n"),
        F.array(*[F.count_if(h & wrong) for h in held]).alias("errors"),
        F.count("*").alias("whole"),
    )
    told = [
        (F.abs(F.col("n")[i] / F.col("whole") - F.lit(r["row_share"])) < 1e-9)
        & (F.abs(F.coalesce(F.try_divide(F.col("errors")[i], F.col("n")[i]), F.lit(0.0)) - F.lit(r["error_rate"])) < 1e-9)
        for i, r in enumerate(tree)
    ]
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda s, x: s + x)
    return counts.select(total("n").alias("n"), total("errors").alias("errors"), F.forall(F.array(*told), lambda t: t).alias("as_told"))


@query(
    f"""WITH {SCORED_SQL} SELECT 1.0::double AS row_share, round(avg((label <> prediction)::int), 6) AS error_rate FROM scored"""
)
def error_tree_totals(spark, sf):
    """The cohorts of the error tree cover all rows, and their rates add up to the whole rate."""
    tree = C.error_tree(scored_lines(spark, sf), F.col("label") != F.col("prediction"), _TREE_FEATS)
    share = F.col("row_share")
    return rounded(
        tree.agg(F.sum(share).alias("row_share"), F.sum(share * F.col("error_rate")).alias("error_rate")), "row_share", "error_rate"
    )


_COHORT_METRICS = f"""{_COHORT_SQL}, g AS (SELECT size, count(*) AS n, avg((label = prediction)::int) AS accuracy, avg(prediction) AS selection_rate,
    count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
    count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM cohort GROUP BY 1),
  r AS (SELECT size, margin, sum(label) AS pos, sum(1 - label) AS neg FROM cohort GROUP BY ALL),
  b AS (SELECT *, sum(neg) OVER (PARTITION BY size ORDER BY margin) - neg AS below FROM r),
  a AS (SELECT size, sum(pos * (below + neg / 2.0))::double / (sum(pos)::double * sum(neg)::double) AS auc FROM b GROUP BY 1),
  metrics AS (SELECT g.size, n, accuracy, selection_rate, coalesce(tp / nullif(tp + fp, 0), 0)::double AS precision,
    coalesce(tp / nullif(tp + fn, 0), 0)::double AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)::double AS f1, auc FROM g JOIN a ON g.size = a.size)"""


def _metrics(spark, sf):
    return C.cohort_metrics(_cohort_lines(spark, sf), "size", "label", "prediction", "margin")


@query(
    f"""WITH {_COHORT_METRICS} SELECT size, n, """
    + ", ".join(f"round({m}, 6) AS {m}" for m in ("accuracy", "selection_rate", "precision", "recall", "f1", "auc"))
    + " FROM metrics"
)
def cohort_metrics(spark, sf):
    return rounded(_metrics(spark, sf), "accuracy", "selection_rate", "precision", "recall", "f1", "auc")


@query(
    f"WITH {_COHORT_METRICS} "
    + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, round(min({m}), 6) AS lowest, round(max({m}), 6) AS highest, round(max({m}) - min({m}), 6) + 0.0 AS gap FROM metrics"
        for m in ("accuracy", "precision", "recall", "f1", "auc")
    )
)
def fairness_gaps(spark, sf):
    return rounded(C.fairness_gaps(_metrics(spark, sf)), "lowest", "highest", "gap")


@query(
    f"""WITH {SCORED_SQL} SELECT least(floor(score * 10), 9)::bigint AS bucket, count(*) AS n, round(avg(score), 6) AS mean_score,
        round(avg(label), 6) AS observed_rate FROM scored GROUP BY 1"""
)
def calibration(spark, sf):
    return longs(rounded(C.calibration(scored_lines(spark, sf), "label", "score"), "mean_score", "observed_rate"), "bucket")


@query(
    f"""WITH {_PHI_SQL}, {SCORED_SQL} SELECT 'importance' AS insight, feature, round(avg(abs(shap)), 6) AS mean_abs_shap, NULL::double AS bucket, NULL::double AS n FROM long GROUP BY 2
        UNION ALL SELECT 'calibration', NULL, NULL, least(floor(score * 10), 9)::double, count(*)::double FROM scored GROUP BY 4"""
)
def gather_insights(spark, sf):
    parts = {
        "importance": E.importance(_attribution(spark, sf)).drop("rank"),
        "calibration": C.calibration(scored_lines(spark, sf), "label", "score").select("bucket", "n"),
    }
    return rounded(C.gather(parts), "mean_abs_shap", "bucket", "n")


def flagship(spark, sf):
    """Features built on lineitem, the scorer, and its metrics per cohort of the built quantity groups."""
    features = FeatureConfig(
        bins=(Bin("l_quantity", [0, 10, 30, 1000], ["small", "medium", "large"], "size"),),
        dates=(DateParts("l_shipdate", ("year", "month")),),
    )
    rows, _ = prepare(scored_lines(spark, sf), None, None, features)
    return rounded(
        C.cohort_metrics(rows, "size", "label", "prediction", "margin"), "accuracy", "selection_rate", "precision", "recall", "f1", "auc"
    )
