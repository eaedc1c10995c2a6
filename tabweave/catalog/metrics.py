"""Queries over metrics, on the fixed linear scorer."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabweave.catalog.base import LINE_KEY, SCORED_SQL, hash_sql, longs, query, rounded, scored_lines, table
from tabweave.operators import metrics as M
from tabweave.operators.split import split_by_bucket

_BUCKET = f"{hash_sql(*LINE_KEY)} % 100"


@query(
    f"""WITH {SCORED_SQL} SELECT CASE WHEN {_BUCKET} < 20 THEN 'test' ELSE 'train' END AS split, count(*) AS n,
        round(avg((label = prediction)::int), 6) AS accuracy FROM scored GROUP BY 1"""
)
def accuracy(spark, sf):
    rows = split_by_bucket(scored_lines(spark, sf), LINE_KEY, 20)
    return rounded(M.accuracy(rows, "label", "prediction", ["split"]), "accuracy")


_COUNTS = """c AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM scored)"""


@query(
    f"""WITH {SCORED_SQL}, {_COUNTS} SELECT round(coalesce(tp / nullif(tp + fp, 0), 0), 6)::double AS precision,
        round(coalesce(tp / nullif(tp + fn, 0), 0), 6)::double AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6)::double AS f1 FROM c"""
)
def prf_binary(spark, sf):
    return rounded(M.prf_binary(scored_lines(spark, sf), "label", "prediction"), "precision", "recall", "f1")


_PER_CLASS = """k AS (SELECT unnest([0, 1]) AS class),
  per AS (SELECT class, count(*) FILTER (label = class) AS support, count(*) FILTER (prediction = class) AS guessed,
    count(*) FILTER (label = class AND prediction = class) AS tp FROM scored, k GROUP BY class),
  m AS (SELECT class, support, coalesce(tp / nullif(guessed, 0), 0)::double AS precision, coalesce(tp / nullif(support, 0), 0)::double AS recall,
    coalesce(2 * tp / nullif(guessed + support, 0), 0)::double AS f1 FROM per)"""


@query(
    f"""WITH {SCORED_SQL}, {_PER_CLASS} SELECT """
    + ", ".join(f"round(sum({x} * support) / sum(support), 6) AS {x}_weighted, round(avg({x}), 6) AS {x}_macro" for x in ("precision", "recall", "f1"))
    + " FROM m"
)
def prf_weighted(spark, sf):
    out = M.prf_averaged(scored_lines(spark, sf), "label", "prediction")
    return rounded(out, *out.columns)


@query(
    f"""WITH {SCORED_SQL}, {_PER_CLASS}, r AS (
        SELECT class::varchar AS name, precision, recall, f1, support FROM m
        UNION ALL SELECT 'accuracy', a, a, a, s FROM (SELECT sum(recall * support) / sum(support) AS a, sum(support) AS s FROM m)
        UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM m
        UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
          sum(f1 * support) / sum(support), sum(support) FROM m)
        SELECT name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support::bigint AS support FROM r"""
)
def classification_report(spark, sf):
    return rounded(M.classification_report(scored_lines(spark, sf), "label", "prediction"), "precision", "recall", "f1")


@query(f"WITH {SCORED_SQL} SELECT label::bigint AS label, prediction::bigint AS prediction, count(*) AS n FROM scored GROUP BY ALL")
def confusion_matrix(spark, sf):
    return longs(M.confusion(scored_lines(spark, sf), "label", "prediction"), "label", "prediction")


_AUC = """r AS (SELECT {1}, sum({0}) AS pos, sum(1 - ({0})) AS neg FROM {2} GROUP BY ALL),
  b AS (SELECT *, sum(neg) OVER ({3} ORDER BY margin) - neg AS below FROM r)"""


@query(
    f"WITH {SCORED_SQL}, {_AUC.format('label', 'margin', 'scored', '')} SELECT round(sum(pos * (below + neg / 2.0))::double / (sum(pos)::double * sum(neg)::double), 6) AS auc FROM b"
)
def roc_auc(spark, sf):
    return rounded(M.roc_auc(scored_lines(spark, sf), "label", "margin"), "auc")


@query(
    f"""WITH {SCORED_SQL}, {_AUC.format('label', 'l_linestatus, margin', 'scored', 'PARTITION BY l_linestatus')}
        SELECT l_linestatus, round(sum(pos * (below + neg / 2.0))::double / (sum(pos)::double * sum(neg)::double), 6) AS auc FROM b GROUP BY 1"""
)
def roc_auc_by_group(spark, sf):
    return rounded(M.roc_auc(scored_lines(spark, sf), "label", "margin", ["l_linestatus"]), "auc")


@query(
    """WITH s AS (SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y, l_discount AS s0, l_tax AS s1, l_quantity AS s2 FROM lineitem),
       l AS (SELECT 0 AS cls, (y = 0)::int AS hit, s0 AS margin FROM s UNION ALL SELECT 1, (y = 1)::int, s1 FROM s UNION ALL SELECT 2, (y = 2)::int, s2 FROM s),
       """
    + _AUC.format("hit", "cls, margin", "l", "PARTITION BY cls")
    + """, e AS (SELECT cls, sum(pos * (below + neg / 2.0))::double / (sum(pos)::double * sum(neg)::double) AS auc, sum(pos) AS support FROM b GROUP BY 1)
       SELECT round(sum(auc * support) / sum(support), 6)::double AS auc_weighted FROM e"""
)
def auc_weighted(spark, sf):
    y = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    rows = table(spark, sf, "lineitem").select(y.alias("y"), "l_discount", "l_tax", "l_quantity")
    return rounded(M.auc_weighted(rows, "y", {0: "l_discount", 1: "l_tax", 2: "l_quantity"}), "auc_weighted")


@query(
    f"""WITH {SCORED_SQL}, f AS (SELECT {_BUCKET} % 5 AS fold, avg((label = prediction)::int) AS a FROM scored GROUP BY 1)
        SELECT count(*) AS folds, round(avg(a), 6) AS mean_accuracy, round(2.0 * stddev_pop(a), 6) AS two_std FROM f"""
)
def cv_accuracy(spark, sf):
    from tabweave.functions.columns import hash_percent

    rows = scored_lines(spark, sf).withColumn("fold", hash_percent([F.col(k) for k in LINE_KEY]) % 5)
    return rounded(M.cv_summary(rows, "label", "prediction", "fold"), "mean_accuracy", "two_std")


_PRED = "(1500.0 * l_quantity)"


@query(
    f"""WITH p AS (SELECT l_extendedprice AS y, {_PRED} AS p FROM lineitem),
        e AS (SELECT count(*) AS n, avg((y-p)*(y-p)) AS mse, var_pop(y) AS v, max(y) - min(y) AS w, avg(abs(y-p)) AS mae FROM p)
        SELECT n, round(1 - mse / v, 6) AS r2, round(sqrt(mse), 6) AS rmse, round(sqrt(mse) / w, 6) AS rmse_normalised, round(mae, 6) AS mae,
          round(mae / w, 6) AS mae_normalised FROM e"""
)
def regression_metrics(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("p", F.lit(1500.0) * F.col("l_quantity"))
    out = M.regression_metrics(rows, "l_extendedprice", "p")
    return rounded(out, "r2", "rmse", "rmse_normalised", "mae", "mae_normalised")


@query(
    """WITH r AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS rx,
         rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS ry FROM lineitem)
       SELECT count(*) AS n, round(corr(rx, ry), 6) AS spearman FROM r"""
)
def spearman(spark, sf):
    return rounded(M.spearman(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"), "spearman")
