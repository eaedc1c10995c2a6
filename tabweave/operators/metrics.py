"""Metrics over (label, prediction, score) columns, each a grouped aggregation.

``by`` repeats a metric per group. Rank metrics first collapse rows to one row per
distinct score, so a hot score costs one row, and no task sorts all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.functions.columns import quoted
from tabweave.plans.lookup import lookup_join
from tabweave.plans.ordered import key_boundaries, prefix_sums


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def accuracy(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    hit = (quoted(label) == quoted(prediction)).cast("double")
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.avg(hit).alias("accuracy"))


def binary_counts(label: str, prediction: str) -> list[Column]:
    """Aggregates tp, fp and fn for class 1."""
    y, p = quoted(label) == 1, quoted(prediction) == 1
    return [F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn")]


def binary_ratios() -> list[Column]:
    """Precision, recall and F1 from tp, fp and fn; a zero denominator gives 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return [
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def prf_binary(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 of class 1."""
    return df.groupBy(*by).agg(*binary_counts(label, prediction)).select(*by, *binary_ratios())


def confusion(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, quoted(label).alias("label"), quoted(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def per_class(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class, computed from the confusion counts."""
    cells = confusion(df, label, prediction, by)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("bigint")
    sides = cells.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.col("label").cast("double").alias("class"), F.col("n").alias("s"), zero.alias("g"), hit.alias("t")),
                F.struct(F.col("prediction").cast("double").alias("class"), zero.alias("s"), F.col("n").alias("g"), zero.alias("t")),
            )
        ),
    )
    c = sides.groupBy(*by, "class").agg(
        F.sum("s").alias("support"), F.sum("g").alias("guessed"), F.sum("t").alias("tp")
    )
    return c.select(
        *by,
        "class",
        _ratio(F.col("tp"), F.col("guessed")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("guessed") + F.col("support")).alias("f1"),
        "support",
    )


def prf_averaged(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Support-weighted and macro precision, recall and F1."""
    names = ("precision", "recall", "f1")
    total = F.sum("support")
    return (
        per_class(df, label, prediction, by)
        .groupBy(*by)
        .agg(
            *[_ratio(F.sum(F.col(m) * F.col("support")), total).alias(f"{m}_weighted") for m in names],
            *[F.avg(m).alias(f"{m}_macro") for m in names],
        )
    )


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per-class rows, then accuracy, macro and weighted averages, as (name, P, R, F1, support)."""
    rows = per_class(df, label, prediction)
    names = ("precision", "recall", "f1")
    total = F.sum("support")
    weighted = [_ratio(F.sum(F.col(m) * F.col("support")), total) for m in names]
    hits = _ratio(F.sum(F.col("recall") * F.col("support")), total)

    def entry(name: str, cols: Sequence[Column]) -> Column:
        return F.struct(F.lit(name).alias("name"), *[c.alias(m) for c, m in zip(cols, names)], total.alias("support"))

    summary = rows.agg(
        F.array(
            entry("accuracy", [hits, hits, hits]),
            entry("macro avg", [F.avg(m) for m in names]),
            entry("weighted avg", weighted),
        ).alias("a")
    ).select(F.inline("a"))
    shown = rows.select(F.col("class").cast("int").cast("string").alias("name"), *names, "support")
    return shown.unionByName(summary)


def _curve(df: DataFrame, label: Column, score: str, by: Sequence[str]) -> DataFrame:
    """Per distinct score: positives, negatives, and how many of each lie below.

    Both running totals are used by ``_area``, so that both branches of the running sum need
    the same columns and share one shuffle of the scores.
    """
    rows = df.where(quoted(score).isNotNull() & label.isNotNull())
    bounds = key_boundaries(rows, score)
    groups = rows.groupBy(*by, quoted(score).alias("s")).agg(
        F.sum(label.cast("bigint")).alias("pos"), F.sum((1 - label).cast("bigint")).alias("neg")
    )
    return prefix_sums(groups, "s", ["pos", "neg"], bounds, by)


def _area() -> Column:
    """Pairs ranked right (ties half) over all pairs, as an aggregate of a curve."""
    won = F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / F.lit(2.0))
    # The last running totals are the class sizes; as doubles their product cannot overflow.
    positives = F.max(F.col("pos_before") + F.col("pos")).cast("double")
    negatives = F.max(F.col("neg_before") + F.col("neg")).cast("double")
    return F.try_divide(F.sum(won), positives * negatives)


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties count half; null if a class is missing."""
    curve = _curve(df, (quoted(label) == 1).cast("int"), score, by)
    return curve.groupBy(*by).agg(_area().alias("auc"))


def auc_weighted(df: DataFrame, label: str, scores: dict[int, str], by: Sequence[str] = ()) -> DataFrame:
    """One-vs-rest AUC per class, weighted by class support. ``scores`` maps class -> score column."""
    entries = [
        F.struct(
            F.lit(c).alias("_class"),
            (quoted(label) == F.lit(c)).cast("int").alias("_hit"),
            quoted(s).cast("double").alias("_score"),
        )
        for c, s in scores.items()
    ]
    long = df.select(*by, F.inline(F.array(*entries)))
    curve = _curve(long, F.col("_hit"), "_score", [*by, "_class"])
    each = curve.groupBy(*by, "_class").agg(_area().alias("auc"), F.sum("pos").alias("support"))
    # A class without positives has no AUC and no weight.
    kept = F.when(F.col("auc").isNotNull(), F.col("support"))
    mean = F.try_divide(F.sum(F.col("auc") * kept), F.sum(kept).cast("double"))
    return each.groupBy(*by).agg(mean.alias("auc_weighted"))


def cv_summary(df: DataFrame, label: str, prediction: str, fold: str) -> DataFrame:
    """Mean accuracy over folds and twice its population standard deviation."""
    folds = accuracy(df, label, prediction, [fold])
    return folds.agg(
        F.count("*").alias("folds"),
        F.avg("accuracy").alias("mean_accuracy"),
        (F.lit(2.0) * F.stddev_pop("accuracy")).alias("two_std"),
    )


def regression_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """R2, RMSE and MAE, the last two also divided by the label's range; one pass."""
    y, p = quoted(label).cast("double"), quoted(prediction).cast("double")
    span = F.max(y) - F.min(y)
    rmse = F.sqrt(F.avg((y - p) * (y - p)))
    mae = F.avg(F.abs(y - p))
    return df.groupBy(*by).agg(
        F.count("*").alias("n"),
        # var_pop(y) * n is the total sum of squares around the mean.
        (F.lit(1.0) - F.try_divide(F.avg((y - p) * (y - p)), F.var_pop(y))).alias("r2"),
        rmse.alias("rmse"),
        F.try_divide(rmse, span).alias("rmse_normalised"),
        mae.alias("mae"),
        F.try_divide(mae, span).alias("mae_normalised"),
    )


def _average_ranks(pairs: DataFrame, rows: DataFrame, column: str, distinct: int) -> DataFrame:
    """(_key, _v, _n): each distinct value, its average rank and its rows."""
    groups = pairs.groupBy(quoted(column).alias("_key")).agg(F.sum("w").alias("_n"))
    ranked = prefix_sums(groups, "_key", ["_n"], key_boundaries(rows, column, distinct=distinct))
    rank = F.col("_n_before").cast("double") + (F.col("_n") + F.lit(1)) / F.lit(2.0)
    return ranked.select("_key", rank.alias("_v"), "_n")


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Spearman correlation with average ranks.

    Rows collapse to distinct (x, y) pairs first, in one shuffle that the ranks of both
    columns reuse; then both values look up their rank.
    """
    rows = df.select(quoted(x).cast("double").alias("x"), quoted(y).cast("double").alias("y")).dropna()
    total, nx, ny = rows.agg(F.count("*"), F.approx_count_distinct("x"), F.approx_count_distinct("y")).first()
    pairs = rows.groupBy("x", "y").agg(F.count("*").alias("w"))
    ranked = pairs
    for c, distinct in (("x", nx), ("y", ny)):
        # The number of values is an estimate; 100 bytes for each of them is a safe bound for broadcasting.
        ranked = lookup_join(ranked, _average_ranks(pairs, rows, c, distinct), c, 100 * distinct, total)
        ranked = ranked.withColumnRenamed("_v", f"r{c}")
    w, middle = F.col("w"), F.lit((total + 1) / 2.0)
    dx, dy = F.col("rx") - middle, F.col("ry") - middle
    return ranked.agg(
        F.sum("w").alias("n"),
        F.try_divide(F.sum(w * dx * dy), F.sqrt(F.sum(w * dx * dx) * F.sum(w * dy * dy))).alias("spearman"),
    )
