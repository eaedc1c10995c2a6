"""Trees of large tables, grown on weighted cells instead of rows.

A tree sees a feature only through its bins, so rows with equal bins and equal labels are one instance with a weight. All
rows are counted into such cells once; their number is bounded by the bins, whatever the rows, and the levels of all trees
are grown by Spark ML on the cells. A boosted tree is the same on cells as on rows: of squared error, too, since what labels
differ inside a cell no split can change. A forest's bootstrap draws rows: of n rows in a cell it takes Poisson(n), and of
numbers it adds up each row's own draws. Every feature takes one value per bin, and bins meet in the middle between two such
values, which is where Spark splits: the thresholds hold for raw rows as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, TaskContext, inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.functions.columns import quoted
from tabweave.session import fresh_dir

#: Tables shorter than this, or with more cells, are trained on as rows.
CELLS_FROM, MAX_CELLS = 50_000, 500_000
#: Cells of a partition; trees that are grown at once; sums a task holds while it draws a regression forest's samples.
CELLS_PER_TASK, TREES_AT_ONCE, SUMS_HELD = 50_000, 8, 2_000_000
#: Spark takes the values of all cells for thresholds, none by sample, as long as this squared exceeds MAX_CELLS.
ALL_VALUES = 1024
TREES_PER_DRAW = 100


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in batch.columns]


# ------------------------------------------------------------------------ bins


def _buckets(rows: DataFrame, edges: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Per feature the rows, the smallest and the largest value of each bucket that has rows, in order (3 x buckets)."""
    names = list(edges)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f, v in enumerate(_columns(batch) if batch.num_rows else []):
                v = np.sort(v)
                at = np.searchsorted(edges[names[f]], v, "left")
                first = np.flatnonzero(np.diff(at, prepend=-1))
                n = np.diff(first, append=len(v))
                parts = (np.full(len(first), f), at[first], n, v[first], v[first + n - 1])
                yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], names=["f", "b", "n", "lo", "hi"])

    met = rows.select(*[quoted(c) for c in names]).mapInArrow(count, "f long, b long, n long, lo double, hi double")
    met = met.groupBy("f", "b").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    out: dict[str, list] = {c: [] for c in names}
    for r in met.orderBy("f", "b").collect():
        out[names[r["f"]]].append((r["n"], r["lo"], r["hi"]))
    return {c: np.array(v, float).T for c, v in out.items()}


def bin_values(rows: DataFrame, ends: dict[str, tuple[float, float]], bins: int) -> dict[str, np.ndarray]:
    """One value per bin of each feature, at most ``bins``: all values of a feature if they are so few, else its quantiles.

    Buckets with more than a quarter of a bin are counted again more finely, and so are all while they are few. Nothing is
    random, and the order of the rows does not matter.
    """
    edges = {c: np.unique(np.linspace(lo, hi, 1025)[:-1]) for c, (lo, hi) in ends.items()}
    out: dict[str, np.ndarray] = {}
    for _ in range(24):
        for c, (n, lo, hi) in _buckets(rows, edges).items():
            wide = (lo < hi) & ((n * 4 * bins > n.sum()) | (len(n) <= 4 * bins))
            out[c] = _representatives(n, lo, hi, bins)
            finer = [np.linspace(a, b, 33)[:-1] for a, b in zip(lo[wide], hi[wide])]
            edges[c] = np.unique(np.concatenate([edges[c], *finer])) if finer else np.array([])
        edges = {c: e for c, e in edges.items() if len(e)}
        if not edges:
            break
    return out


def _representatives(n: np.ndarray, lo: np.ndarray, hi: np.ndarray, bins: int) -> np.ndarray:
    if len(n) <= bins:
        return np.unique(np.where(lo < hi, lo / 2 + hi / 2, lo))
    # A value that fills a bin is a bin; the others share what is left.
    own = (lo == hi) & (n * bins >= n.sum())
    rest = bins - int(own.sum())
    if rest <= 0:
        return np.unique(lo[own])
    n, lo_, hi_ = n[~own], lo[~own], hi[~own]
    upto = np.cumsum(n)
    ranks = (np.arange(rest) + 0.5) / rest * upto[-1]
    at = np.searchsorted(upto, ranks, "left")
    inside = (ranks - (upto - n)[at]) / n[at]
    return np.unique(np.concatenate([lo[own], lo_[at] + inside * (hi_[at] - lo_[at])]))


# ----------------------------------------------------------------------- cells


class Cells:
    """The rows of a table dealt into cells of their features."""

    def __init__(self, rows: DataFrame, features: Sequence[str], label: str, values: dict[str, np.ndarray]):
        self.features, self.label = list(features), label
        self.rows = rows.select(*[quoted(c) for c in self.features], quoted(label))
        self.values = [values[c] for c in self.features]
        self.strides = _strides(self.values)
        self.size = math.prod(len(v) for v in self.values)

    def _codes(self):
        meets = [(v[:-1] + v[1:]) / 2 for v in self.values]
        strides = self.strides

        def codes(columns: list[np.ndarray]) -> np.ndarray:
            return sum(np.searchsorted(e, x, "left") * s for e, x, s in zip(meets, columns, strides))

        return codes

    def by_class(self, classes: int) -> DataFrame:
        """(code, label, n): rows of each cell and class."""
        codes = self._codes()

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                *x, y = _columns(batch)
                both, n = np.unique(codes(x) * classes + y.astype(np.int64), return_counts=True)
                parts = (both // classes, (both % classes).astype(float), n.astype(float))
                yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], names=["code", "y", "n"])

        met = self.rows.mapInArrow(count, "code long, y double, n double")
        return met.groupBy("code", "y").agg(F.sum("n").alias("n"))

    def means(self) -> DataFrame:
        """(code, y, n): rows of each cell and the mean of their labels."""
        codes = self._codes()

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                *x, y = _columns(batch)
                code, at = np.unique(codes(x), return_inverse=True)
                parts = (code, np.bincount(at, y, len(code)), np.bincount(at, None, len(code)).astype(float))
                yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], names=["code", "s", "n"])

        met = self.rows.mapInArrow(add, "code long, s double, n double").groupBy("code").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        return met.select("code", (F.col("s") / F.col("n")).alias("y"), "n")

    def drawn_means(self, trees: range, seed: int) -> DataFrame:
        """(code, w, m): per tree the rows that its bootstrap draws from the cell, and the mean of their labels."""
        codes, size, wide = self._codes(), self.size, len(trees)
        # Poisson(1) by its distribution function; 16 is out of reach of 53 bits.
        upto = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(17)])

        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rng = np.random.default_rng([seed, trees.start, TaskContext.get().partitionId()])
            sums = np.zeros((2, size, wide))
            for batch in batches:
                *x, y = _columns(batch)
                for part in range(0, len(y), 2048):
                    some = slice(part, part + 2048)
                    code = codes([v[some] for v in x])
                    by = np.argsort(code, kind="stable")
                    first = np.flatnonzero(np.diff(code[by], prepend=-1))
                    w = np.searchsorted(upto, rng.random((len(by), wide)), "right").astype(float)
                    at = code[by][first]
                    sums[0, at] += np.add.reduceat(w, first)
                    sums[1, at] += np.add.reduceat(w * y[some][by][:, None], first)
            code, tree = np.nonzero(sums[0])
            parts = (code, tree, sums[0, code, tree], sums[1, code, tree])
            for part in range(0, len(code), 100_000):
                some = slice(part, part + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(p[some]) for p in parts], names=["code", "t", "w", "s"])

        met = self.rows.mapInArrow(draw, "code long, t long, w double, s double")
        met = met.groupBy("code", "t").agg(F.sum("w").alias("w"), F.sum("s").alias("s"))
        held = met.groupBy("code").agg(F.map_from_entries(F.collect_list(F.struct("t", F.struct("w", (F.col("s") / F.col("w")).alias("m"))))).alias("of"))
        each = [F.col("of")[F.lit(i).cast("long")] for i in range(wide)]
        return held.select("code", F.array(*[F.coalesce(e["w"], F.lit(0.0)) for e in each]).alias("w"), F.array(*[e["m"] for e in each]).alias("m"))

    def placed(self, cells: DataFrame, *more: str) -> DataFrame:
        """Cells with a vector of their features' values in few partitions, whose order depends on the cells alone."""
        value = [F.array(*[F.lit(float(x)) for x in v])[(F.floor(F.col("code") / s) % len(v)).cast("int")] for v, s in zip(self.values, self.strides)]
        named = [v.alias(f"_x{i}") for i, v in enumerate(value)]
        out = VectorAssembler(inputCols=[f"_x{i}" for i in range(len(named))], outputCol="features").transform(cells.select("code", *more, *named))
        tasks = min(cells.sparkSession.sparkContext.defaultParallelism, -(-self.size // CELLS_PER_TASK))
        return out.select("code", "features", *more).repartition(max(1, tasks), "code").sortWithinPartitions("code", *[c for c in more if c == "y"])


# ------------------------------------------------------------------------ fits


def fit_by_cells(estimator: Estimator, rows: DataFrame, features: Sequence[str], label: str, n: int, classes: int) -> Model | None:
    """The estimator's model of all rows, or None where cells do not serve: then it is to be fitted on the rows."""
    forest = isinstance(estimator, (RandomForestClassifier, RandomForestRegressor))
    boosted = isinstance(estimator, (GBTClassifier, GBTRegressor))
    if n < CELLS_FROM or not features or not (forest or boosted) or estimator.getSubsamplingRate() != 1.0 or estimator.isSet("weightCol"):
        return None
    if boosted and (estimator.isSet("validationIndicatorCol") or (not classes and estimator.getLossType() != "squared")):
        return None
    if forest and not estimator.getBootstrap():
        return None
    ends = _ends(rows, features, label, classes)
    if ends is None:
        return None
    cells = Cells(rows, features, label, bin_values(rows, ends, estimator.getMaxBins()))
    if cells.size * max(1, classes) > MAX_CELLS:
        return None
    least = estimator.getMinInstancesPerNode()
    estimator = estimator.copy()
    estimator.setParams(weightCol="w", maxBins=ALL_VALUES, minInstancesPerNode=1)
    model = _fit(estimator, cells, classes, least, n, forest)
    model.cell_values = cells.values
    return model


def _fit(estimator: Estimator, cells: Cells, classes: int, least: int, n: int, forest: bool) -> Model:
    label = cells.label
    if forest:
        return _forest_of_classes(estimator, cells, classes, least) if classes else _forest(estimator, cells, least)
    if least > 1:
        estimator.setMinWeightFractionPerNode((least - 0.5) / n)
    held = cells.placed(cells.by_class(classes) if classes else cells.means(), "y", "n")
    held = held.select("features", _label(F.col("y"), label, classes), F.col("n").alias("w")).persist()
    try:
        return estimator.fit(held)
    finally:
        held.unpersist()


def _label(c, name: str, classes: int):
    """The label; of classes it tells their number, which a sample need not show."""
    return c.alias(name, metadata={"ml_attr": {"type": "nominal", "num_vals": classes}}) if classes else c.alias(name)


def _ends(rows: DataFrame, features: Sequence[str], label: str, classes: int) -> dict[str, tuple[float, float]] | None:
    """Smallest and largest value of each feature; None where a value is missing, infinite or no class."""
    odd = [c.isNull() | F.isnan(c) | (F.abs(c) == math.inf) for c in map(quoted, [*features, label])]
    if classes:
        odd.append((quoted(label) < 0) | (quoted(label) != F.floor(quoted(label))))
    ends = [f(quoted(c)).alias(f"{k}{i}") for i, c in enumerate(features) for k, f in (("lo", F.min), ("hi", F.max))]
    row = rows.agg(*[F.count_if(c).alias(f"odd{i}") for i, c in enumerate(odd)], *ends).first()
    if any(row[f"odd{i}"] for i in range(len(odd))):
        return None
    return {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(features)}


def _forest(estimator: Estimator, cells: Cells, least: int) -> Model:
    """A forest of numbers whose trees are grown on the cells, each with the weights of its own bootstrap."""
    spark = cells.rows.sparkSession
    total, seed, label = estimator.getNumTrees(), estimator.getSeed(), cells.label
    subset = estimator.getFeatureSubsetStrategy()
    if subset == "auto":
        subset = "all" if total == 1 else "onethird"
    step = max(1, min(TREES_PER_DRAW, SUMS_HELD // cells.size))
    grown: list[Model] = []
    for start in range(0, total, step):
        trees = range(start, min(total, start + step))
        held = cells.placed(cells.drawn_means(trees, seed), "w", "m").persist()
        try:
            drawn = held.agg(F.array(*[F.sum(F.col("w")[i]) for i in range(len(trees))])).first()[0]

            @inheritable_thread_target(spark)
            def grow(i: int) -> Model:
                mine = held.where(F.col("w")[i] > 0).select("features", F.col("m")[i].alias(label), F.col("w")[i].alias("w"))
                one = estimator.copy()
                one.setParams(numTrees=1, bootstrap=False, featureSubsetStrategy=subset, seed=seed + trees[i])
                if least > 1:
                    one.setMinWeightFractionPerNode((least - 0.5) / max(drawn[i], 2.0 * least))
                return one.fit(mine)

            with ThreadPoolExecutor(TREES_AT_ONCE) as pool:
                waiting = [pool.submit(grow, i) for i in range(len(trees))]
                try:
                    grown += [w.result() for w in waiting]
                except BaseException:
                    pool.shutdown(wait=True, cancel_futures=True)
                    raise
        finally:
            held.unpersist()
    return _joined(estimator, grown)


def _joined(estimator: Estimator, grown: Sequence[Model]) -> Model:
    """One forest of the trees of many."""
    context = SparkContext._active_spark_context
    ml = context._jvm.org.apache.spark.ml
    trees = context._gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(grown))
    for i, one in enumerate(grown):
        trees[i] = one._java_obj.trees()[0]
    model = RandomForestRegressionModel(ml.regression.RandomForestRegressionModel(estimator.uid, trees, grown[0].numFeatures))
    estimator._copyValues(model)._transfer_params_to_java()
    return model


# --------------------------------------------------------------------- scoring


def score_by_cells(model: Model, df: DataFrame) -> DataFrame:
    """The model's ``prediction`` and, of classes, ``_proba`` for vectors of features, looked up by their cells.

    A model grown on cells says the same of all rows of a cell, so it is asked once per cell, in tasks; the table is bounded
    by MAX_CELLS and kept with the model. A row then costs a search among the bins instead of a walk down every tree.
    """
    values = model.cell_values
    if getattr(model, "cell_table", None) is None:
        model.cell_table = _cell_table(model, df.sparkSession, values)
    table, meets, strides = model.cell_table, [(v[:-1] + v[1:]) / 2 for v in values], _strides(values)

    @F.arrow_udf("array<double>")
    def look_up(vectors: pa.Array) -> pa.Array:
        x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), len(meets))
        at = sum(np.searchsorted(e, x[:, i], "left") * s for i, (e, s) in enumerate(zip(meets, strides)))
        ends = np.arange(len(x) + 1, dtype=np.int32) * table.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(table[at].ravel()))

    told = df.withColumn("_told", look_up(vector_to_array(model.getFeaturesCol())))
    out = told.withColumn(model.getPredictionCol(), F.col("_told")[0])
    if table.shape[1] > 1:
        out = out.withColumn("_proba", F.slice("_told", 2, table.shape[1] - 1))
    return out.drop("_told")


def _strides(values: Sequence[np.ndarray]) -> list[int]:
    return [math.prod(len(v) for v in values[:i]) for i in range(len(values))]


def _cell_table(model: Model, spark, values: Sequence[np.ndarray]) -> np.ndarray:
    """Prediction and probabilities of each cell, by its code."""
    size = math.prod(len(v) for v in values)
    tasks = max(1, min(spark.sparkContext.defaultParallelism, size // 1000))
    at = [F.array(*[F.lit(float(x)) for x in v])[(F.floor(F.col("id") / s) % len(v)).cast("int")] for v, s in zip(values, _strides(values))]
    said = model.transform(spark.range(0, size, 1, tasks).select("id", array_to_vector(F.array(*at)).alias(model.getFeaturesCol())))
    proba = [vector_to_array(model.getProbabilityCol()).alias("p")] if hasattr(model, "numClasses") else []
    told = said.select("id", model.getPredictionCol(), *proba).toArrow()
    columns = [told.column(1).to_numpy()[:, None]]
    if proba:
        columns.append(told.column(2).combine_chunks().flatten().to_numpy().reshape(size, -1))
    return np.hstack(columns)[np.argsort(told.column(0).to_numpy())]


# ----------------------------------------------------------- forests of classes


class Growing:
    """A tree of bins: nodes in the order they were made, children side by side, and the features that open nodes try."""

    def __init__(self, classes: int):
        self.feature, self.cut, self.left = (np.full(1, -1) for _ in range(3))
        self.gain, self.stats = np.zeros(1), np.zeros((1, classes))
        self.open, self.tried = np.zeros(1, np.int64), np.zeros((1, 0), np.int64)

    def node_of(self, x: np.ndarray) -> np.ndarray:
        """Node that each row of bins has come to."""
        rows, at = np.arange(len(x)), np.zeros(len(x), np.int64)
        while (inner := self.feature[at] >= 0).any():
            right = x[rows, np.maximum(self.feature[at], 0)] > self.cut[at]
            at = np.where(inner, self.left[at] + right, at)
        return at

    def split(self, best: dict, least: float, impurity: str) -> None:
        """Split the open nodes that gain by it; children that may split again are open then."""
        slot, cut, gain = (np.array(best[c]) for c in ("slot", "cut", "gain"))
        whole, below = (np.array(best[c]).reshape(len(gain), -1) for c in ("whole", "below"))
        self.stats[self.open] = whole
        good = gain > 0
        ids, size = self.open[good], len(self.feature)
        first = size + 2 * np.arange(len(ids))
        self.feature[ids], self.cut[ids], self.left[ids], self.gain[ids] = self.tried[good, slot[good]], cut[good], first, gain[good]
        new = np.stack([below[good], (whole - below)[good]], axis=1).reshape(2 * len(ids), -1)
        none = np.full(len(new), -1)
        self.feature, self.cut, self.left = (np.concatenate([v, none]) for v in (self.feature, self.cut, self.left))
        self.gain, self.stats = np.concatenate([self.gain, np.zeros(len(new))]), np.concatenate([self.stats, new])
        self.open = size + np.flatnonzero((new.sum(axis=1) >= 2 * least) & (_impurity(new, impurity) > 0))

    def pruned(self) -> list[np.ndarray]:
        """(feature, cut, left, right, gain, stats) without leaves that predict the same as their siblings, as Spark leaves them out."""
        said, feature = self.stats.argmax(axis=1), self.feature.copy()
        for i in np.flatnonzero(feature >= 0)[::-1]:
            a = self.left[i]
            if feature[a] < 0 and feature[a + 1] < 0 and said[a] == said[a + 1]:
                feature[i] = -1
        kept = np.zeros(len(feature), bool)
        kept[0] = True
        for i in np.flatnonzero(feature >= 0):
            kept[self.left[i]] = kept[self.left[i] + 1] = kept[i]
        number, inner = np.cumsum(kept) - 1, feature >= 0
        left, right = (np.where(inner, number[np.maximum(self.left, 0) + side], -1) for side in (0, 1))
        return [v[kept] for v in (feature, self.cut, left, right, np.where(inner, self.gain, -1.0), self.stats)]


def _impurity(stats: np.ndarray, kind: str) -> np.ndarray:
    """Gini impurity or entropy of class weights along the last axis; 0 of none."""
    p = stats / np.maximum(stats.sum(axis=-1, keepdims=True), 1e-300)
    if kind == "gini":
        return np.where(stats.sum(axis=-1) > 0, 1 - (p * p).sum(axis=-1), 0.0)
    return -(p * np.log2(np.where(p > 0, p, 1.0))).sum(axis=-1)


def _tried(strategy: str, width: int, trees: int) -> int:
    """Number of features that a node tries, by Spark's names."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    known = {"all": width, "sqrt": math.ceil(math.sqrt(width)), "log2": max(1, math.ceil(math.log2(width))), "onethird": math.ceil(width / 3)}
    if strategy in known:
        return known[strategy]
    return min(width, int(strategy)) if strategy.isdigit() else max(1, math.ceil(float(strategy) * width))


def _forest_of_classes(estimator: Estimator, cells: Cells, classes: int, least: int) -> Model:
    """A forest whose bootstraps draw Poisson(n) of a cell's n rows; a level of up to a hundred trees is one job.

    A task has a part of the cells and a block of trees, and adds the drawn weights by node, feature and bin. The sums of a
    tree meet in a group, which picks its nodes' splits. What a cell is drawn depends on seed, tree and cells alone.
    """
    width, seed, total = len(cells.features), estimator.getSeed(), estimator.getNumTrees()
    tried, bins, impurity = _tried(estimator.getFeatureSubsetStrategy(), width, total), max(map(len, cells.values)), estimator.getImpurity()
    cores = cells.rows.sparkSession.sparkContext.defaultParallelism
    parts = -(-cells.size // CELLS_PER_TASK)
    counted = cells.by_class(classes).repartition(parts, "code").sortWithinPartitions("code", "y").persist()
    strides, sizes = np.array(cells.strides), np.array([len(v) for v in cells.values])
    least_share, least_gain = estimator.getMinWeightFractionPerNode(), estimator.getMinInfoGain()

    def sums_of(growing: list[Growing], trees: range, first: int):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [_columns(b) for b in batches if b.num_rows]
            if not held:
                return
            code, y, n = (np.concatenate(c) for c in zip(*held))
            x = code[:, None] // strides % sizes
            # The parts of the cells are the partitions of each block of the union.
            rng = np.random.default_rng([seed, trees.start, TaskContext.get().partitionId() % parts])
            drawn = rng.poisson(n[:, None], (len(n), len(trees)))
            for t, w in zip(trees, drawn.T):
                g = growing[t - first]
                if not len(g.open):
                    continue
                place = np.full(len(g.feature), -1)
                place[g.open] = np.arange(len(g.open))
                node = place[g.node_of(x)]
                inside = np.flatnonzero((node >= 0) & (w > 0))
                node, mine, some = node[inside], w[inside], x[inside]
                sums = np.zeros(len(g.open) * tried * bins * classes)
                for s in range(tried):
                    b = some[np.arange(len(some)), g.tried[node, s]]
                    at = ((node * tried + s) * bins + b) * classes + y[inside].astype(np.int64)
                    sums += np.bincount(at, mine, len(sums))
                at = np.flatnonzero(sums)
                lists = [pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), pa.array(v)) for v in (at, sums[at])]
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int64()), *lists], names=["t", "at", "w"])

        return add

    def best_of(growing: list[Growing], first: int):
        opened, roots = [len(g.open) for g in growing], [g.stats[0].sum() for g in growing]

        def pick(table: pa.Table) -> pa.Table:
            t = table["t"][0].as_py()
            shape = (opened[t - first], tried, bins, classes)
            at, w = (table[c].combine_chunks().flatten().to_numpy() for c in ("at", "w"))
            below = np.cumsum(np.bincount(at, w, math.prod(shape)).reshape(shape), axis=2)
            whole = below[:, :1, -1:]
            above, n = whole - below, whole.sum(axis=-1)
            n_below, n_above = below.sum(axis=-1), above.sum(axis=-1)
            floor = max(least, least_share * (roots[t - first] or whole[0].sum()))
            fall = _impurity(whole, impurity) - (n_below * _impurity(below, impurity) + n_above * _impurity(above, impurity)) / np.maximum(n, 1)
            fall = np.where((n_below >= floor) & (n_above >= floor) & (n_below > 0) & (n_above > 0) & (fall >= least_gain), fall, -1.0)
            fall = fall.reshape(len(fall), -1)
            lead = fall.argmax(axis=1)
            rows = np.arange(len(fall))
            left = below.reshape(len(fall), -1, classes)[rows, lead]
            out = (lead // bins, lead % bins, fall[rows, lead], whole.reshape(-1), left.reshape(-1))
            return pa.table([pa.array([t], pa.int64()), *[pa.array([v.tolist()]) for v in out]], names=["t", "slot", "cut", "gain", "whole", "below"])

        return pick

    grown: list[Growing] = []
    try:
        for start in range(0, total, TREES_PER_DRAW):
            some = range(start, min(total, start + TREES_PER_DRAW))
            block = max(1, -(-len(some) // max(1, -(-cores // parts))))
            growing = [Growing(classes) for _ in some]
            for level in range(estimator.getMaxDepth()):
                for t, g in zip(some, growing):
                    chance = np.random.default_rng([seed, t, level]).random((len(g.open), width))
                    g.tried = np.sort(np.argsort(chance, axis=1)[:, :tried], axis=1)
                if not any(len(g.open) for g in growing):
                    break
                blocks = [some[i : i + block] for i in range(0, len(some), block)]
                met = [counted.mapInArrow(sums_of(growing, trees, start), "t long, at array<long>, w array<double>") for trees in blocks]
                met = reduce(DataFrame.unionAll, met).groupBy("t")
                best = met.applyInArrow(best_of(growing, start), "t long, slot array<long>, cut array<long>, gain array<double>, whole array<double>, below array<double>")
                for r in best.collect():
                    growing[r["t"] - start].split(r.asDict(), least, impurity)
            grown += growing
    finally:
        counted.unpersist()
    return _as_spark(estimator, cells, grown, classes)


def _as_spark(estimator: Estimator, cells: Cells, grown: Sequence[Growing], classes: int) -> Model:
    """The trees as Spark's forest, by way of a saved model: one of a single leaf per tree is saved, and its nodes replaced."""
    spark = cells.rows.sparkSession
    stub = estimator.copy()
    stub.setParams(numTrees=len(grown), maxDepth=0, bootstrap=False)
    rows = spark.range(1).select(
        array_to_vector(F.array(*[F.lit(0.0) for _ in cells.features])).alias("features"), _label(F.lit(0.0), cells.label, classes), F.lit(1.0).alias("w")
    )
    old, new = fresh_dir(spark, "stub"), fresh_dir(spark, "forest")
    stub.fit(rows).save(old)
    spark.read.text(f"{old}/metadata").coalesce(1).write.text(f"{new}/metadata")
    spark.read.parquet(f"{old}/treesMetadata").coalesce(1).write.parquet(f"{new}/treesMetadata")
    meets = [((v[:-1] + v[1:]) / 2).tolist() for v in cells.values]
    nodes = []
    for t, g in enumerate(grown):
        feature, cut, left, right, gain, stats = g.pruned()
        told = (stats.argmax(axis=1).astype(float), _impurity(stats, estimator.getImpurity()), stats, stats.sum(axis=1).astype(int), gain, left, right)
        splits = [(f, [meets[f][c]], -1) if f >= 0 else (-1, [], -1) for f, c in zip(feature.tolist(), cut.tolist())]
        nodes += [(t, (i, *node)) for i, node in enumerate(zip(*[v.tolist() for v in told], splits))]
    spark.createDataFrame(nodes, spark.read.parquet(f"{old}/data").schema, verifySchema=False).write.parquet(f"{new}/data")
    model = RandomForestClassificationModel.load(new)
    estimator._copyValues(model)._transfer_params_to_java()
    return model
