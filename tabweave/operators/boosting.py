"""Joint boosting of several classes: per round one regression tree per class on the residuals of the softmax.

Features are cut once into at most ``maxBins`` quantile bins, and rows with equal bins and class are counted into one cell,
on which all rounds work. A level of a round is one Spark job for the trees of all
classes: tasks add gradients into histograms, which are summed by cell; the best split of each node comes to the driver. The margins of the classes are a column that is written again every few rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.session import written

# Margins are written again after so many rounds; until then each job walks the newer trees.
ROUNDS_PER_WRITE = 10
LOSS = -1
CELLS_HERE = 500_000
_CELLS = "tree int, node int, feature int, bin int, g double, h double, n long"
_SPLITS = "tree int, node int, feature int, bin int, gl double, hl double, g double, h double, gain double"
_CELL_NAMES = [f.split()[0] for f in _CELLS.split(", ")]

# A tree is a list of [feature, threshold, left, right, value]; a leaf has feature -1.
Tree = list[list[float]]


def walk(trees: list[Tree], x: np.ndarray) -> np.ndarray:
    """Value of each tree (columns) for each row of features; values up to the threshold go left."""
    out = np.zeros((len(x), len(trees)))
    rows = np.arange(len(x))
    for t, tree in enumerate(trees):
        nodes = np.array(tree, float)
        feature, left, right = (nodes[:, k].astype(np.int64) for k in (0, 2, 3))
        at = np.zeros(len(x), np.int64)
        while (inner := feature[at] >= 0).any():
            below = x[rows, np.maximum(feature[at], 0)] <= nodes[at, 1]
            at = np.where(inner, np.where(below, left[at], right[at]), at)
        out[:, t] = nodes[at, 4]
    return out


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def leaf_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Index of the node of an unfinished tree that each row ends in."""
    numbered = [[*n[:4], float(i)] for i, n in enumerate(tree)]
    return walk([numbered], x)[:, 0].astype(np.int64)


def _unpack(batch: pa.RecordBatch, n_features: int, n_classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bins, classes, margins and numbers of rows of a batch of cells as arrays."""

    def flat(k: int, width: int) -> np.ndarray:
        return batch.column(k).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)

    return flat(0, n_features), batch.column(1).to_numpy(zero_copy_only=False), flat(2, n_classes), batch.column(3).to_numpy(zero_copy_only=False)


def best_splits(rows: DataFrame, newer: list[Tree], growing: list[Tree], open_nodes: list[set[int]], bins: int, least: int, sizes: tuple[int, int], with_loss: bool) -> list:
    """One job: the best split of each open node of the growing trees (trees of bins, not of values), and the loss.

    Of equal gains the lowest feature, then the lowest bin wins.
    """
    n_features, n_classes = sizes
    place = [{n: i for i, n in enumerate(sorted(o))} for o in open_nodes]

    def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((3, len(p) * n_features * bins)) for p in place]
        loss, seen = 0.0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, margins, n = _unpack(batch, n_features, n_classes)
            for r in range(0, len(newer), n_classes):
                margins = margins + walk(newer[r : r + n_classes], x)
            p = softmax(margins)
            if with_loss:
                loss -= (n * np.log(np.maximum(p[np.arange(len(y)), y], 1e-300))).sum()
                seen += int(n.sum())
            for k, (tree, nodes) in enumerate(zip(growing, place)):
                if not nodes:
                    continue
                number = np.full(len(tree), -1)
                number[list(nodes)] = list(nodes.values())
                node = number[leaf_of(tree, x)]
                inside = node >= 0
                g = (y == k)[inside] - p[inside, k]
                held = n[inside]
                h = held * np.abs(g) * (1 - np.abs(g))
                for f in range(n_features):
                    cell = (node[inside] * n_features + f) * bins + x[inside, f]
                    for i, w in enumerate((held * g, h, held)):
                        sums[k][i] += np.bincount(cell, w, sums[k].shape[1])
        out: list[list[np.ndarray]] = [[] for _ in _CELL_NAMES]
        for k, nodes in enumerate(place):
            at = np.flatnonzero(sums[k][2])
            names = np.array(sorted(nodes), np.int64)
            values = (np.full(len(at), k), names[at // (n_features * bins)] if len(at) else at, at // bins % n_features, at % bins, *sums[k][:, at])
            for o, v in zip(out, values):
                o.append(v)
        if seen:
            for o, v in zip(out, (LOSS, 0, 0, 0, loss, 0.0, seen)):
                o.append(np.array([v]))
        kinds = [pa.int32()] * 4 + [pa.float64()] * 2 + [pa.int64()]
        arrays = [pa.array(np.concatenate(o).astype(t.to_pandas_dtype()), t) for o, t in zip(out, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=_CELL_NAMES)

    met = rows.mapInArrow(histograms, _CELLS).groupBy("tree", "node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in "ghn"])
    # Cells are bounded by classes x nodes x features x bins, whatever the rows: few are judged here, many by node in tasks.
    if sum(map(len, place)) * n_features * bins <= CELLS_HERE:
        return pick_splits(met.toArrow(), least).to_pylist()
    return met.groupBy("tree", "node").applyInArrow(lambda t: pick_splits(t, least), _SPLITS).collect()


def pick_splits(cells: pa.Table, least: int) -> pa.Table:
    """The best split of every (tree, node) by the fall of squared error; gain -1 where none leaves enough rows on both sides."""
    names = [cells.column(c).to_numpy() for c in ("tree", "node", "feature", "bin")]
    by = np.lexsort(names[::-1])
    tree, node, feature, bin_ = (v[by] for v in names)
    first = np.ones(len(by), bool)
    first[1:] = (np.diff(tree) != 0) | (np.diff(node) != 0) | (np.diff(feature) != 0)
    starts, group = np.flatnonzero(first), np.cumsum(first) - 1
    left, total = {}, {}
    for c in "ghn":
        v = cells.column(c).to_numpy()[by]
        upto = np.cumsum(v)
        left[c] = upto - (upto - v)[starts][group]
        total[c] = (np.add.reduceat(v, starts) if len(v) else v)[group]
    n_right = total["n"] - left["n"]
    allowed = (left["n"] >= least) & (n_right >= least) & (n_right > 0)
    safe = np.maximum(n_right, 1)
    gain = left["g"] ** 2 / left["n"] + (total["g"] - left["g"]) ** 2 / safe - total["g"] ** 2 / total["n"]
    gain = np.where(allowed, gain, -1.0)
    order = np.lexsort((bin_, feature, -gain, node, tree))
    lead = np.ones(len(order), bool)
    lead[1:] = (np.diff(tree[order]) != 0) | (np.diff(node[order]) != 0)
    at = order[lead]
    columns = [tree, node, feature, bin_, left["g"], left["h"], total["g"], total["h"], gain]
    return pa.table([pa.array(c[at]) for c in columns], names=[f.split()[0] for f in _SPLITS.split(", ")])


class SoftmaxBoost(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Gradient boosting of all classes together; labels are 0, 1, ... and features a vector without NaN.

    Leaves take one Newton step: (K-1)/K * sum(r) / sum(|r| (1-|r|)). Margins start at the logarithms of the class shares.
    Nothing is random; splits of almost equal gain may differ with the order in which sums are added.
    """

    def __init__(self, featuresCol="features", labelCol="label", maxIter=100, maxDepth=5, stepSize=0.1, maxBins=32, minInstancesPerNode=1, seed=42):
        super().__init__()
        if not 2 <= maxBins <= 256:
            raise ValueError("maxBins is between 2 and 256")
        self.names = (featuresCol, labelCol)
        self.rounds, self.depth, self.step = maxIter, maxDepth, stepSize
        self.bins, self.least = maxBins, minInstancesPerNode

    def _fit(self, df: DataFrame) -> "SoftmaxBoostModel":
        features, label = self.names
        rows = df.select(vector_to_array(features).alias("x"), F.col(label).cast("int").alias("y"))
        counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
        if None in counts or not counts or min(counts) < 0:
            raise ValueError("labels must be 0, 1, ... without nulls, in at least one row")
        k = max(counts) + 1
        total = sum(counts.values())
        prior = [float(np.log(max(counts.get(c, 0), 1e-9) / total)) for c in range(k)]
        width = rows.select(F.size("x")).first()[0]
        sizes = (width, k)
        cuts = self._cuts(rows, width)
        rows = self._binned(rows, cuts, prior)
        trees: list[list[Tree]] = []
        losses: list[float] = []
        newer: list[Tree] = []
        for r in range(self.rounds):
            grown, loss = self._round(rows, newer, sizes)
            losses.append(loss / total)
            newer += grown
            trees.append([[[n[0], cuts[int(n[0])][int(n[1])] if n[0] >= 0 else 0.0, *n[2:]] for n in t] for t in grown])
            if (r + 1) % ROUNDS_PER_WRITE == 0 and r + 1 < self.rounds:
                rows, newer = self._advanced(rows, newer, sizes), []
        model = SoftmaxBoostModel()
        model._set(featuresCol=features, prior=prior, trees=trees, losses=losses)
        return model

    def _cuts(self, rows: DataFrame, width: int) -> list[list[float]]:
        """Thresholds per feature; a value up to threshold b and above b-1 has bin b."""
        each = rows.select(*[F.col("x")[j].alias(f"x{j}") for j in range(width)])
        at = [i / self.bins for i in range(1, self.bins)]
        found = each.approxQuantile(each.columns, at, 1 / (8 * self.bins))
        largest = each.agg(*[F.max(c) for c in each.columns]).first()
        return [sorted({v for v in q if v < top}) for q, top in zip(found, largest)]

    def _binned(self, rows: DataFrame, cuts: list[list[float]], prior: list[float]) -> DataFrame:
        edges = [np.array(c, float) for c in cuts]

        @F.pandas_udf("array<smallint>")
        def bins(x: pd.Series) -> pd.Series:
            wide = np.stack(x.to_numpy())
            return pd.Series(list(np.stack([np.searchsorted(e, wide[:, j], "left") for j, e in enumerate(edges)], axis=1).astype(np.int16)))

        cells = rows.select(bins("x").alias("x"), "y").groupBy("x", "y").agg(F.count("*").alias("n"))
        return written(cells.select("x", "y", F.array(*[F.lit(p) for p in prior]).alias("margins"), "n"), "boosting")

    def _round(self, rows: DataFrame, newer: list[Tree], sizes: tuple[int, int]) -> tuple[list[Tree], float]:
        k = sizes[1]
        scale = self.step * (k - 1) / k
        growing: list[Tree] = [[[-1.0, 0.0, 0.0, 0.0, 0.0]] for _ in range(k)]
        open_nodes = [{0} for _ in range(k)]
        loss = 0.0

        def value(g: float, h: float) -> float:
            return scale * g / h if h > 1e-12 else 0.0

        for level in range(self.depth):
            if not any(open_nodes):
                break
            following: list[set[int]] = [set() for _ in range(k)]
            for b in best_splits(rows, newer, growing, open_nodes, self.bins, self.least, sizes, level == 0):
                if b["tree"] == LOSS:
                    loss = b["g"]
                    continue
                tree, node = growing[b["tree"]], b["node"]
                if b["gain"] <= 1e-12:
                    tree[node][4] = value(b["g"], b["h"])
                    continue
                left = len(tree)
                tree[node] = [float(b["feature"]), float(b["bin"]), float(left), float(left + 1), 0.0]
                tree.append([-1.0, 0.0, 0.0, 0.0, value(b["gl"], b["hl"])])
                tree.append([-1.0, 0.0, 0.0, 0.0, value(b["g"] - b["gl"], b["h"] - b["hl"])])
                following[b["tree"]] |= {left, left + 1}
            open_nodes = following
        return growing, loss

    def _advanced(self, rows: DataFrame, newer: list[Tree], sizes: tuple[int, int]) -> DataFrame:
        """The cells with margins that include the newer trees, written."""
        n_features, k = sizes

        def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, _, margins, _ = _unpack(batch, n_features, k)
                for r in range(0, len(newer), k):
                    margins = margins + walk(newer[r : r + k], x)
                new = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * k), pa.array(margins.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), new, batch.column(3)], names=["x", "y", "margins", "n"])

        return written(rows.mapInArrow(advance, "x array<smallint>, y int, margins array<double>, n long"), "boosting")


class SoftmaxBoostModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Trees of all rounds and classes; adds ``_proba`` (one probability per class) and ``prediction``."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector of features", TypeConverters.toString)
    prior = Param(Params._dummy(), "prior", "margins before the first round")
    trees = Param(Params._dummy(), "trees", "per round and class a tree: [feature, threshold, left, right, value] per node")
    losses = Param(Params._dummy(), "losses", "mean log loss of the training rows before each round")

    @property
    def numClasses(self) -> int:
        return len(self.getOrDefault(self.prior))

    def losses_by_round(self) -> list[float]:
        return self.getOrDefault(self.losses)

    def _transform(self, df: DataFrame) -> DataFrame:
        prior, trees = self.getOrDefault(self.prior), self.getOrDefault(self.trees)

        @F.pandas_udf("array<double>")
        def proba(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            wide = np.stack(x.to_numpy())
            margins = np.tile(np.array(prior), (len(wide), 1))
            for of_round in trees:
                margins += walk(of_round, wide)
            return pd.Series(list(softmax(margins)))

        out = df.withColumn("_proba", proba(vector_to_array(self.getOrDefault(self.featuresCol))))
        best = F.array_position("_proba", F.array_max("_proba")) - 1
        return out.withColumn("prediction", best.cast("double"))
