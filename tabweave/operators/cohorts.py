"""Where a model fails: error rates, metrics and calibration by cohort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.functions.columns import quoted
from tabweave.operators.explain import model_leaves
from tabweave.operators.metrics import binary_counts, binary_ratios, roc_auc
from tabweave.session import written


def error_cube(df: DataFrame, error: Column, dims: Sequence[str]) -> DataFrame:
    """Rows, errors, error rate and share of all errors for every combination of cohorts.

    Rows are first counted per full cohort, so the cube multiplies only that small table.
    ``level`` counts the dimensions in use; an unused dimension is null.
    """
    cells = df.groupBy(*[quoted(d).alias(d) for d in dims]).agg(
        F.count("*").alias("_n"), F.sum(error.cast("bigint")).alias("_e")
    )
    total = cells.agg(F.sum("_e")).first()[0] or 0
    level = F.lit(len(dims)) - sum((F.grouping(d).cast("int") for d in dims), F.lit(0))
    cube = cells.cube(*dims).agg(
        level.cast("int").alias("level"), F.sum("_n").alias("n"), F.sum("_e").alias("errors")
    )
    return cube.select(
        *dims,
        "level",
        "n",
        "errors",
        (F.col("errors") / F.col("n")).alias("error_rate"),
        F.coalesce(F.try_divide(F.col("errors").cast("double"), F.lit(float(total))), F.lit(0.0)).alias("coverage"),
    )


def error_tree(df: DataFrame, error: Column, features: Sequence[str], depth: int = 3) -> DataFrame:
    """Cohorts found by a shallow tree on the error flag: rule (a SQL condition), rows share and error rate."""
    rows = df.select(*[quoted(f).cast("double").alias(f) for f in features], error.cast("double").alias("_error"))
    ready = VectorAssembler(inputCols=list(features), outputCol="_x").transform(rows)
    model = DecisionTreeClassifier(featuresCol="_x", labelCol="_error", maxDepth=depth, seed=42).fit(ready)
    out = []
    for leaf in model_leaves(model):
        parts, share = [], 1.0
        for f, lo, hi, s in zip(leaf.features, leaf.lows, leaf.highs, leaf.shares):
            share *= s
            if lo != float("-inf"):
                parts.append(f"`{features[f]}` > {lo!r}D")
            if hi != float("inf"):
                parts.append(f"`{features[f]}` <= {hi!r}D")
        out.append((" and ".join(parts) or "true", float(share), float(leaf.value)))
    return df.sparkSession.createDataFrame(out, "cohort string, row_share double, error_rate double")


def find_slices(
    df: DataFrame, error: Column, features: Sequence[str], min_share: float = 0.01, min_effect: float = 0.2, depth: int = 2
) -> DataFrame:
    """Slices (conditions on up to ``depth`` binned features) whose rows are in error more often than the other rows.

    A slice needs ``min_share`` of all rows and an effect of at least ``min_effect``: the difference of the error rates of
    slice and other rows, over the root of their mean variance (infinite if both rates are certain). A slice that is
    told ends its branch: no narrower slice inside it follows. Narrow slices have few rows, so a slice too small ends its
    branch as well. Null is a value like any other; a null error is none.

    Rows are first counted per full cell, so levels multiply only that table; each level joins the cells with the slices
    that are still open, and slices of which some part is not open are left out before they are told. Returns ``slice``
    (a SQL condition), ``level``, ``n``, ``errors``, ``error_rate``, ``effect``.
    """
    wrong = F.coalesce(error, F.lit(False)).cast("bigint")
    rows = df.select(*[quoted(f).cast("string").alias(f"f{i}") for i, f in enumerate(features)], wrong.alias("e"))
    counted = rows.groupBy(*[f"f{i}" for i in range(len(features))]).agg(F.count("*").alias("n"), F.sum("e").alias("e"))
    each = [F.struct(F.lit(i).alias("f"), F.col(f"f{i}").alias("v")) for i in range(len(features))]
    cells = written(counted.select(F.array(*each).alias("all"), "n", "e"), "cells")
    total, errors = cells.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("e"), F.lit(0))).first()
    rate = F.col("e") / F.col("n")
    other = F.try_divide(errors - F.col("e"), total - F.col("n"))
    spread = F.sqrt((rate * (1 - rate) + other * (1 - other)) / 2)
    apart = F.when(spread > 0, (rate - other) / spread).when(rate > other, F.lit(float("inf"))).otherwise(F.lit(0.0))
    told: list[DataFrame] = []
    held = cells.select("*", F.explode("all").alias("lit")).select("all", "n", "e", F.array("lit").alias("s"))
    open_ = literals = None
    for level in range(1, depth + 1):
        if open_ is not None:
            # A cell's open slices, each with one more open condition on a later feature.
            later = F.filter("all", lambda x: x["f"] > F.element_at("s", -1)["f"])
            longer = held.join(open_, "s", "left_semi").select("all", "n", "e", "s", F.explode(later).alias("lit"))
            held = longer.join(literals, "lit", "left_semi").select("all", "n", "e", F.concat("s", F.array("lit")).alias("s"))
        sums = held.groupBy("s").agg(F.sum("n").alias("n"), F.sum("e").alias("e"))
        sums = sums.where(F.col("n") >= F.lit(min_share * total))
        if level > 2:
            # Every part with one condition less has to be open.
            less = F.transform("s", lambda gone: F.filter("s", lambda x: x["f"] != gone["f"]))
            parts = sums.select("s", F.explode(less).alias("part"))
            whole = parts.join(open_.select(F.col("s").alias("part")), "part").groupBy("s").count().where(F.col("count") == level)
            sums = sums.join(whole.select("s"), "s", "left_semi")
        judged = written(sums.select("s", "n", "e", rate.alias("error_rate"), apart.alias("effect")), "slices")
        found = F.coalesce(F.col("effect") >= min_effect, F.lit(False))
        told.append(judged.where(found).withColumn("level", F.lit(level)))
        open_ = judged.where(~found)
        if level == 1:
            literals = open_.select(F.col("s")[0].alias("lit"))
    names = F.array(*[F.lit("`" + f.replace("`", "``") + "`") for f in features])
    name = lambda x: F.element_at(names, x["f"] + 1)
    text = F.transform("s", lambda x: F.when(x["v"].isNull(), F.concat(name(x), F.lit(" IS NULL"))).otherwise(F.concat(name(x), F.lit(" = '"), F.replace(x["v"], F.lit("'"), F.lit("\\'")), F.lit("'"))))
    out = told[0]
    for more in told[1:]:
        out = out.unionByName(more)
    return out.select(F.array_join(text, " AND ").alias("slice"), "level", "n", F.col("e").alias("errors"), "error_rate", "effect")


def cohort_metrics(df: DataFrame, cohort: str, label: str, prediction: str, score: str) -> DataFrame:
    """Size, accuracy, precision, recall, F1 and AUC per cohort."""
    hit = (quoted(label) == quoted(prediction)).cast("double")
    counted = df.groupBy(cohort).agg(
        F.count("*").alias("n"),
        F.avg(hit).alias("accuracy"),
        F.avg((quoted(prediction) == 1).cast("double")).alias("selection_rate"),
        *binary_counts(label, prediction),
    )
    base = counted.select(cohort, "n", "accuracy", "selection_rate", *binary_ratios())
    # One row per cohort on each side; null cohorts match each other.
    auc = roc_auc(df, label, score, [cohort]).withColumnRenamed(cohort, "_cohort")
    return base.join(auc, quoted(cohort).eqNullSafe(F.col("_cohort")), "left").drop("_cohort")


def fairness_gaps(metrics: DataFrame, names: Sequence[str] = ("accuracy", "precision", "recall", "f1", "auc")) -> DataFrame:
    """Largest minus smallest value of each metric over the cohorts."""
    entries = [
        F.struct(F.lit(m).alias("metric"), F.min(m).alias("lowest"), F.max(m).alias("highest"), (F.max(m) - F.min(m)).alias("gap"))
        for m in names
    ]
    return metrics.agg(F.array(*entries).alias("a")).select(F.inline("a"))


def calibration(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Equal-width buckets of the probability: rows, mean probability, observed rate."""
    p = quoted(score).cast("double")
    bucket = F.least(F.floor(p * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(bucket.alias("bucket")).agg(
        F.count("*").alias("n"),
        F.avg(p).alias("mean_score"),
        F.avg((quoted(label) == 1).cast("double")).alias("observed_rate"),
    )


def gather(parts: dict[str, DataFrame]) -> DataFrame:
    """All insight tables as one tall table, marked by ``insight``; missing columns are null."""
    out = None
    for name, df in parts.items():
        marked = df.select(F.lit(name).alias("insight"), "*")
        out = marked if out is None else out.unionByName(marked, allowMissingColumns=True)
    if out is None:
        raise ValueError("nothing to gather")
    return out
