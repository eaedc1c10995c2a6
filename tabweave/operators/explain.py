"""Shapley attributions as tables.

An ``Attribution`` is a wide DataFrame: key columns, feature columns, one ``phi_<feature>``
column each, and ``base_value``; base + sum of phi is the model output. Reports aggregate the
wide form, so no report multiplies rows by features unless the long table itself is wanted.
"""

from __future__ import annotations

import json
import math
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import astuple, dataclass
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.functions.columns import quoted
from tabweave.plans.ordered import exact_quantiles
from tabweave.session import fresh_dir


@dataclass
class Attribution:
    df: DataFrame
    keys: list[str]
    features: list[str]

    def phi(self, feature: str) -> Column:
        return quoted(f"phi_{feature}")


# --------------------------------------------------------------------- linear


def background_means(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(quoted(f).cast("double")) for f in features]).first()
    return dict(zip(features, row))


def linear_attribution(
    df: DataFrame, keys: Sequence[str], weights: dict[str, float], intercept: float, means: dict[str, float]
) -> Attribution:
    """phi = weight * (x - background mean); base = score of the mean. A projection only."""
    features = list(weights)
    base = intercept + sum(weights[f] * means[f] for f in features)
    wide = df.select(
        *[quoted(k) for k in keys],
        *[quoted(f).cast("double").alias(f) for f in features if f not in keys],
        *[
            (F.lit(float(weights[f])) * (quoted(f).cast("double") - F.lit(float(means[f])))).alias(f"phi_{f}")
            for f in features
        ],
        F.lit(float(base)).alias("base_value"),
    )
    return Attribution(wide, list(keys), features)


# ---------------------------------------------------------------------- trees


@dataclass
class Leaf:
    """One leaf: its value, and per feature on its path the accepted values and cover share."""

    value: float
    features: list[int]
    lows: list[float]
    highs: list[float]
    accepted: list[frozenset[int] | None]
    shares: list[float]


@dataclass
class Tree:
    """Nodes of one tree by number, the root first: feature, threshold or left categories (and how many there are), children, value, cover share of the parent."""

    features: list[int]
    cuts: list[float]
    chosen: list[frozenset[int] | None]
    arity: list[int]
    left: list[int]
    right: list[int]
    values: list[float]
    shares: list[float]


def model_trees(model: Any, target_class: int = 1) -> list[Tree]:
    """Trees of a Spark tree ensemble, scaled so that their sum is the model output.

    The node table is read from the saved model; its size is the size of the model.
    Boosted classifiers give the margin, forests the class probability or the mean.
    """
    spark = _session()
    path = fresh_dir(spark, "trees")
    model.save(path)
    stored = spark.read.parquet(f"{path}/data")
    single = "treeID" not in stored.columns
    nodes = stored.select(F.lit(0).alias("treeID"), F.struct(*stored.columns).alias("nodeData")) if single else stored
    by_tree: dict[int, dict[int, Any]] = {}
    for r in nodes.collect():
        by_tree.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
    names = type(model).__name__
    boosted = names.startswith("GBT")
    classifies = "Classification" in names and not boosted
    weights = list(getattr(model, "treeWeights", [1.0] * len(by_tree)))
    return [_tree(by_tree[t], weights[t] if boosted else 1.0 / len(by_tree), classifies, target_class) for t in sorted(by_tree)]


def _tree(nodes: dict[int, Any], scale: float, classifies: bool, target: int) -> Tree:
    place = {n: i for i, n in enumerate(sorted(nodes))}
    out = Tree([], [], [], [], [], [], [], [1.0] * len(nodes))

    def weight(node: Any) -> float:
        # Rows by weight: of classes the statistics are their weights, of numbers the first one is the weight.
        return sum(node["impurityStats"]) if classifies else node["impurityStats"][0]

    for n in sorted(nodes):
        node, split = nodes[n], nodes[n]["split"]
        inner = node["leftChild"] >= 0
        by_set = inner and split["numCategories"] >= 0
        stats = node["impurityStats"]
        value = (stats[target] / sum(stats) if sum(stats) else 0.0) if classifies else node["prediction"]
        out.features.append(split["featureIndex"] if inner else -1)
        out.cuts.append(split["leftCategoriesOrThreshold"][0] if inner and not by_set else math.nan)
        out.chosen.append(frozenset(int(c) for c in split["leftCategoriesOrThreshold"]) if by_set else None)
        out.arity.append(split["numCategories"] if by_set else 0)
        out.values.append(scale * value)
        for side, children in (("leftChild", out.left), ("rightChild", out.right)):
            children.append(place[node[side]] if inner else -1)
            if inner:
                out.shares[place[node[side]]] = weight(nodes[node[side]]) / weight(node) if weight(node) else 0.0
    return out


def model_leaves(model: Any, target_class: int = 1) -> list[Leaf]:
    """Leaves of a Spark tree ensemble, scaled so that their sum is the model output."""
    return tree_leaves(model_trees(model, target_class))


def tree_leaves(trees: Sequence[Tree]) -> list[Leaf]:
    """The leaves of all trees with what their paths ask of each feature."""
    out: list[Leaf] = []
    for t in trees:
        _walk(t, 0, {}, out)
    return out


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()


def _walk(t: Tree, i: int, path: dict[int, tuple], out: list[Leaf]) -> None:
    f = t.features[i]
    if f < 0:
        fs = sorted(path)
        out.append(Leaf(t.values[i], fs, *[[path[g][k] for g in fs] for k in range(4)]))
        return
    for child, left in ((t.left[i], True), (t.right[i], False)):
        lo, hi, accepted, share = path.get(f, (-math.inf, math.inf, None, 1.0))
        if t.chosen[i] is None:
            lo, hi = (lo, min(hi, t.cuts[i])) if left else (max(lo, t.cuts[i]), hi)
        else:
            side = t.chosen[i] if left else frozenset([*range(t.arity[i]), OTHER]) - t.chosen[i]
            accepted = side if accepted is None else accepted & side
        _walk(t, child, {**path, f: (lo, hi, accepted, share * t.shares[child])}, out)


#: Every value that is none of a feature's categories; it goes right at each split.
OTHER = -1
#: Bytes of the table of all cells of an ensemble, which is broadcast, and additions for it, up to which it is made.
GRID_BYTES, GRID_STEPS = 64 << 20, 1 << 31
#: Rows whose paths are walked at once; the memory of a walk is this times the depth, however many nodes there are.
WALK_ROWS = 4096


def _cells(leaves: Sequence[tuple]) -> dict[int, np.ndarray]:
    """Upper ends of the cells of each feature that a leaf asks for; the last cell is open and holds NaN, too."""
    ends: dict[int, set[float]] = {}
    for _, features, lows, highs, accepted, _ in leaves:
        for f, lo, hi, some in zip(features, lows, highs, accepted):
            own = ends.setdefault(f, set())
            own.update(v for v in (lo, hi) if math.isfinite(v))
            # A category is a cell of its own.
            own.update(v for c in some or () if c != OTHER for v in (float(c), float(np.nextafter(c, -math.inf))))
    return {f: np.array(sorted(v)) for f, v in sorted(ends.items())}


class GridShares:
    """Path-dependent attributions of an ensemble as a table of all cells of its features.

    Between two neighbouring thresholds of a feature the ensemble is constant, and Spark's trees share the thresholds of
    their histogram bins. For each set S of features, what the ensemble is expected to give when S is known is a sum of boxes
    over the cells of S, one box per leaf, and takes differences at the boxes' corners and running sums. All attributions of a
    cell are weighted differences of these tables. A row looks its cell up, whatever the number of leaves.
    """

    def __init__(self, leaves: Sequence[tuple]):
        self.ends = _cells(leaves)
        self.names = list(self.ends)
        m = len(self.names)
        self.shape = tuple(len(self.ends[f]) + 1 for f in self.names)
        boxes = self._boxes(leaves)
        value = np.array([b[0] for b in boxes])
        first, last, run, share = (np.array([b[k] for b in boxes]).reshape(len(boxes), m) for k in (1, 2, 3, 4))
        self.table = np.zeros((*self.shape, m))
        self.base = 0.0
        for s in range(1 << m):
            known = [j for j in range(m) if s >> j & 1]
            # Of the runs of a feature that is not known, one stands for all.
            weight = value * np.prod(np.where([[s >> j & 1 for j in range(m)]], 1.0, share * (run == 0)), axis=1)
            shape = tuple(self.shape[j] + 1 for j in known)
            sums = np.zeros(math.prod(shape))
            for corner in range(1 << len(known)):
                at = np.zeros(len(boxes), np.int64)
                for k, j in enumerate(known):
                    at = at * shape[k] + (last[:, j] + 1 if corner >> k & 1 else first[:, j])
                sums += (-1) ** corner.bit_count() * np.bincount(at, weight, len(sums))
            sums = sums.reshape(shape)
            for k in range(len(known)):
                sums = np.cumsum(sums, axis=k)
            sums = sums[tuple(slice(0, n - 1) for n in shape)]
            sums = sums.reshape([self.shape[j] if j in known else 1 for j in range(m)])
            if not known:
                self.base = float(sums.sum())
            for j in range(m):
                others = len(known) - (s >> j & 1)
                size_weight = math.factorial(others) * math.factorial(m - 1 - others) / math.factorial(m)
                self.table[..., j] += (size_weight if s >> j & 1 else -size_weight) * sums
        self.table = self.table.reshape(-1, m)

    def _boxes(self, leaves: Sequence[tuple]) -> list[tuple]:
        """(value, first cells, last cells, numbers of the runs, shares) of boxes; a set of cells in several runs gives several."""
        out = []
        for value, features, lows, highs, accepted, shares in leaves:
            asked = {f: k for k, f in enumerate(features)}
            ways = [((), (), ())]
            share = []
            for f, n in zip(self.names, self.shape):
                k = asked.get(f)
                share.append(1.0 if k is None else shares[k])
                runs = [(0, n - 1)] if k is None else self._runs(f, n, lows[k], highs[k], accepted[k])
                ways = [((*a, x), (*b, y), (*c, r)) for a, b, c in ways for r, (x, y) in enumerate(runs)]
            out += [(value, *way, share) for way in ways]
        return out

    def _runs(self, f: int, n: int, lo: float, hi: float, some: frozenset[int] | None) -> list[tuple[int, int]]:
        ends = self.ends[f]
        first = 0 if lo == -math.inf else int(np.searchsorted(ends, lo)) + 1
        last = n - 1 if hi == math.inf else int(np.searchsorted(ends, hi))
        good = np.zeros(n, bool)
        good[first : last + 1] = True
        if some is not None:
            inside = np.zeros(n, bool)
            # Below each end: a category if its lower neighbour is an end as well.
            single = {int(np.searchsorted(ends, c)): int(c) for c in ends[1:] if c == int(c) and np.nextafter(c, -math.inf) in ends}
            single |= {0: int(ends[0])} if ends[0] == int(ends[0]) and np.nextafter(ends[0], -math.inf) in ends else {}
            for cell in range(n):
                inside[cell] = single[cell] in some if cell in single else OTHER in some
            good &= inside
        edge = np.flatnonzero(np.diff(np.concatenate(([0], good.astype(int), [0]))))
        # A path may ask for what no value meets.
        return [(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2])] or [(0, -1)]

    @staticmethod
    def fits(leaves: Sequence[tuple]) -> bool:
        """Whether the table stays below its limits."""
        ends = _cells(leaves)
        cells, m = math.prod(len(e) + 1 for e in ends.values()), len(ends)
        return cells * max(1, m) * 8 <= GRID_BYTES and (len(leaves) * 3**m + cells * m * 2**m) <= GRID_STEPS

    def phi(self, x: np.ndarray) -> np.ndarray:
        """Attributions of some rows: rows x features."""
        out = np.zeros(x.shape)
        at = np.zeros(len(x), np.int64)
        for f, n in zip(self.names, self.shape):
            at = at * n + np.searchsorted(self.ends[f], x[:, f])
        out[:, self.names] = self.table[at]
        return out


class PathShares:
    """Path-dependent attributions by one walk over each tree for a block of rows.

    Going down, a row carries for each feature of the path whether it meets what the path asks (o) and the cover share of that
    (z). The share of feature j in a leaf is an integral over t of (o_j - z_j) times the product of o_i t + z_i (1 - t) over the
    other features, a polynomial that a few nodes t integrate exactly. So the product at the nodes is all that is carried: an
    edge divides the old factor of its feature out and multiplies the new one in, and going up the sums over the leaves below an
    edge give that feature its part. The work is linear in the number of nodes.
    """

    def __init__(self, trees: Sequence[Tree]):
        self.trees = list(trees)
        width = max((_width(t, 0, frozenset()) for t in trees), default=1)
        t, w = np.polynomial.legendre.leggauss(max(1, (width + 1) // 2))
        self.t, self.w = (t[:, None] + 1) / 2, w / 2
        self.base = sum(_expected(t, 0) for t in trees)

    def phi(self, x: np.ndarray) -> np.ndarray:
        """Attributions of some rows: rows x features."""
        out = np.zeros((x.shape[1], len(x)))
        for a in range(0, len(x), WALK_ROWS):
            block = np.ascontiguousarray(x[a : a + WALK_ROWS].T)
            for t in self.trees:
                self._descend(t, 0, block, {}, np.ones((len(self.t), block.shape[1])), out[:, a : a + WALK_ROWS])
        return out.T

    def _descend(self, t: Tree, i: int, x: np.ndarray, held: dict[int, tuple], product: np.ndarray, phi: np.ndarray) -> np.ndarray:
        """Sum of value times product over the leaves below a node, at each t; adds what the edges below give to `phi`."""
        f = t.features[i]
        if f < 0:
            return t.values[i] * product
        # A NaN goes right at every threshold.
        goes_left = x[f] <= t.cuts[i] if t.chosen[i] is None else np.isin(x[f], list(t.chosen[i]))
        met, share, _, gain = held.get(f, (None, 1.0, None, None))
        rest = product if met is None else product * held[f][2]
        total = np.zeros_like(product)
        for child, goes in ((t.left[i], goes_left), (t.right[i], ~goes_left)):
            o = (goes if met is None else goes & met).astype(float)
            z = share * t.shares[child]
            factor = o * self.t + z * (1 - self.t)
            inverse = np.divide(1.0, factor, out=np.zeros_like(factor), where=factor > 0)
            own = (o - z) * inverse
            below = self._descend(t, child, x, {**held, f: (o > 0, z, inverse, own)}, rest * factor, phi)
            phi[f] += np.einsum("q,qr,qr->r", self.w, own if gain is None else own - gain, below)
            total += below
        return total


def _width(t: Tree, i: int, seen: frozenset[int]) -> int:
    if t.features[i] < 0:
        return len(seen)
    seen = seen | {t.features[i]}
    return max(_width(t, t.left[i], seen), _width(t, t.right[i], seen))


def _expected(t: Tree, i: int) -> float:
    if t.features[i] < 0:
        return t.values[i]
    return sum(t.shares[c] * _expected(t, c) for c in (t.left[i], t.right[i]))


def tree_phi(x: np.ndarray, leaves: list[tuple]) -> np.ndarray:
    """Path-dependent attributions of one batch: rows x features."""
    return GridShares(leaves).phi(x)


def tree_shares(trees: Sequence[Tree]) -> GridShares | PathShares:
    """A table of cells where it is small enough, else walks over the trees; both are exact."""
    leaves = [astuple(leaf) for leaf in tree_leaves(trees)]
    return GridShares(leaves) if GridShares.fits(leaves) else PathShares(trees)


def tree_attribution(df: DataFrame, keys: Sequence[str], features: Sequence[str], model: Any, target_class: int = 1) -> Attribution:
    """Tree attributions of every row, in Arrow batches; only the model, or a table of its cells, is sent to the tasks."""
    shares = tree_shares(model_trees(model, target_class))
    base = float(shares.base)
    # By value, as functions are: executors need no copy of this package.
    shared = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(shares))
    names, kept = list(features), list(keys)
    schema = T.StructType(
        [df.schema[k] for k in kept]
        + [T.StructField(f, T.DoubleType()) for f in names]
        + [T.StructField(f"phi_{f}", T.DoubleType()) for f in names]
        + [T.StructField("base_value", T.DoubleType())]
    )
    columns = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shares = pickle.loads(shared.value)
        for batch in batches:
            own = [batch.column(i) for i in range(len(kept), batch.num_columns)]
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in own], axis=1) if own else np.zeros((batch.num_rows, 0))
            phi = shares.phi(x)
            parts = [*[batch.column(i) for i in range(len(kept))], *own, *[pa.array(phi[:, i]) for i in range(len(names))]]
            yield pa.RecordBatch.from_arrays([*parts, pa.array(np.full(batch.num_rows, base))], names=columns)

    inputs = df.select(
        *[quoted(k) for k in kept], *[quoted(f).cast("double").alias(f"_x{i}") for i, f in enumerate(names)]
    )
    return Attribution(inputs.mapInArrow(run, schema), kept, names)


# --------------------------------------------------------------------- kernel


def coalition_weights(m: int, method: str = "exact", coalitions: int = 2048, seed: int = 42) -> tuple[list[int], np.ndarray]:
    """Coalitions as bit masks and the matrix c with phi_j = sum_S c[j, S] * v(S).

    ``exact`` takes all 2**m coalitions with Shapley weights; ``sampled`` a paired sample with
    the weighted least squares solution, which is linear in v as well.
    """
    if method not in ("exact", "sampled"):
        raise ValueError(f"unknown method {method!r}; use exact or sampled")
    if method == "exact" or m < 2:
        masks = list(range(1 << m))
        c = np.zeros((m, len(masks)))
        for s in masks:
            k = s.bit_count()
            for j in range(m):
                if s >> j & 1:
                    c[j, s] = math.factorial(k - 1) * math.factorial(m - k) / math.factorial(m)
                else:
                    c[j, s] = -math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
        return masks, c
    rng = np.random.default_rng(seed)
    sizes = np.arange(1, m)
    chance = (m - 1) / (sizes * (m - sizes))
    drawn: dict[int, float] = {}
    for k in rng.choice(sizes, coalitions // 2, p=chance / chance.sum()):
        s = sum(1 << int(j) for j in rng.choice(m, k, replace=False))
        for t in (s, (1 << m) - 1 - s):
            drawn[t] = drawn.get(t, 0.0) + 1.0
    # Single features and their complements are always in, which keeps the system solvable.
    for j in range(m):
        for t in (1 << j, (1 << m) - 1 - (1 << j)):
            drawn.setdefault(t, 1.0)
    inner = sorted(drawn)
    z = np.array([[s >> j & 1 for j in range(m)] for s in inner], dtype=float)
    w = np.array([drawn[s] for s in inner])
    masks = [0, *inner, (1 << m) - 1]
    inverse = np.linalg.inv(z.T @ (z * w[:, None]))
    free = np.zeros((m, len(masks)))
    free[:, 1:-1] = inverse @ (z * w[:, None]).T
    free[:, 0] = -free[:, 1:-1].sum(axis=1)
    gap = free.sum(axis=0)
    gap[-1] -= 1.0
    gap[0] += 1.0
    ones = inverse.sum(axis=1)
    return masks, free - np.outer(ones / ones.sum(), gap)


def kernel_attribution(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    background: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    score_column: str = "score",
    method: str = "exact",
    coalitions: int = 2048,
) -> Attribution:
    """Attributions for any scorer, here a function that adds a score column to a DataFrame.

    A scorer that works on arrays is better explained by ``array_attribution``, which multiplies no rows. All rows of
    ``background`` are used; the caller samples. Each row is expanded to coalitions x
    background rows inside its own task, scored in bulk, and summed again: since phi is linear in
    the scores, one grouped sum gives all phi. The sum is complete before the shuffle, because the
    copies of a row never leave its task. Equal rows stay apart, and a feature may be a key too.
    ``exact`` grows with 2**features; with many features ask for ``sampled`` coalitions.
    """
    names, kept = list(features), list(keys)
    rows = [[None if math.isnan(v) else v for v in r] for r in background_values(background, names).tolist()]
    masks, c = coalition_weights(len(names), method, coalitions)
    design = [{"m": format(s, "x"), "c": c[:, i].tolist()} for i, s in enumerate(masks)]
    design_col = F.from_json(F.lit(json.dumps(design)), "array<struct<m:string,c:array<double>>>")
    full = format((1 << len(names)) - 1, "x")
    back_col = F.from_json(F.lit(json.dumps(rows)), "array<array<double>>")
    bits = [[bool(s >> j & 1) for j in range(len(names))] for s in masks]
    bits_col = F.from_json(F.lit(json.dumps(bits)), "array<array<boolean>>")
    x = [quoted(f).cast("double").alias(f"_x{i}") for i, f in enumerate(names)]
    own = [quoted(k).alias(f"_k{i}") for i, k in enumerate(kept)]
    # The number of a row is the same for all its copies, which are made in the same task.
    base = _spread(df.select(*own, *x)).select("*", F.monotonically_increasing_id().alias("_row"))
    held = ["_row", *[f"_k{i}" for i in range(len(kept))], *[f"_x{i}" for i in range(len(names))]]
    cased = base.select("*", F.posexplode(F.arrays_zip(design_col.alias("d"), bits_col.alias("b"))).alias("_i", "_s"))
    mixed = cased.select("*", F.explode(back_col).alias("_b")).select(
        *held,
        F.col("_s.d.m").alias("_m"),
        F.col("_s.d.c").alias("_c"),
        *[F.when(F.col("_s.b")[i], F.col(f"_x{i}")).otherwise(F.col("_b")[i]).alias(f) for i, f in enumerate(names)],
    )
    scored = score(mixed)
    n = F.lit(float(len(rows)))
    s = quoted(score_column).cast("double")
    sums = scored.groupBy(*held).agg(
        *[(F.sum(F.col("_c")[i] * s) / n).alias(f"_phi{i}") for i in range(len(names))],
        (F.sum(F.when(F.col("_m") == "0", s)) / n).alias("base_value"),
        (F.sum(F.when(F.col("_m") == full, s)) / n).alias("output"),
    )
    wide = sums.select(
        *[F.col(f"_k{i}").alias(k) for i, k in enumerate(kept)],
        *[F.col(f"_x{i}").alias(f) for i, f in enumerate(names) if f not in kept],
        *[F.col(f"_phi{i}").alias(f"phi_{f}") for i, f in enumerate(names)],
        "base_value",
        "output",
    )
    return Attribution(wide, kept, names)


def _spread(rows: DataFrame) -> DataFrame:
    """Rows of a few input files or row groups, over several tasks a core: each row costs coalitions x background scores."""
    tasks = TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(tasks) if rows.rdd.getNumPartitions() < tasks else rows


BACKGROUND_ROWS = 100
TASKS_PER_CORE = 4
#: Bytes of background values that are sent to the tasks, and values a task scores at once.
BACKGROUND_BYTES, SCORED_AT_ONCE = 8 << 20, 1 << 19


def background_values(background: DataFrame, features: Sequence[str]) -> np.ndarray:
    """The background as an array of rows x features; more than BACKGROUND_BYTES of it, or none, is an error."""
    most = max(1, BACKGROUND_BYTES // (8 * max(1, len(features))))
    rows = background.select(*[quoted(f).cast("double") for f in features]).limit(most + 1).collect()
    if not rows:
        raise ValueError("the background is empty")
    if len(rows) > most:
        raise ValueError(f"the background has more than {most} rows; sample it first, for example with sample_n")
    return np.array([[math.nan if v is None else v for v in r] for r in rows], dtype=float).reshape(len(rows), len(features))


class CoalitionScores:
    """Attributions of a block of rows by a model in array form.

    A row takes its own values for the features of a coalition and each background row's for the others; the mean over the
    background is the coalition's worth. Rows, and coalitions if need be, are taken in blocks, so that at most SCORED_AT_ONCE
    values stand in memory, and the weighted least squares solution is one product with a fixed matrix.
    """

    def __init__(self, predict: Callable[[np.ndarray], np.ndarray] | None, background: np.ndarray, method: str = "exact", coalitions: int = 2048):
        m = background.shape[1]
        masks, self.solution = coalition_weights(m, method, coalitions)
        self.known = np.array([[s >> j & 1 for j in range(m)] for s in masks], dtype=bool).reshape(len(masks), m)
        self.full = masks.index((1 << m) - 1)
        self.predict, self.background = predict, background

    def worth(self, x: np.ndarray) -> np.ndarray:
        """Rows x coalitions."""
        n, m = self.background.shape
        out = np.empty((len(x), len(self.known)))
        some = max(1, SCORED_AT_ONCE // (n * max(1, m)))
        for c in range(0, len(self.known), some):
            known = self.known[c : c + some]
            rows = max(1, some // len(known))
            for r in range(0, len(x), rows):
                part = x[r : r + rows]
                # Column by column, so that what is copied and scored lies side by side.
                mixed = np.empty((m, len(known), len(part), n))
                for j in range(m):
                    mixed[j, known[:, j]] = part[:, j, None]
                    mixed[j, ~known[:, j]] = self.background[:, j]
                scores = np.asarray(self.predict(mixed.reshape(m, len(known) * len(part) * n).T), dtype=float)
                out[r : r + rows, c : c + some] = scores.reshape(len(known), len(part), n).mean(axis=2).T
        return out

    def phi(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Attributions (rows x features), base value and model output of each row."""
        worth = self.worth(x)
        return worth @ self.solution.T, worth[:, 0], worth[:, self.full]


def array_attribution(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    background: DataFrame,
    predict: Callable[[np.ndarray], np.ndarray],
    method: str = "exact",
    coalitions: int = 2048,
) -> Attribution:
    """Attributions for a scorer in array form: a function from rows x features to one score per row.

    Coalitions and background rows are mixed and scored inside the Arrow batches of a task; no row is multiplied in the plan,
    and rows are shuffled only to have tasks for all cores. Only the background (checked, see ``background_values``) and the function are sent to the tasks.
    A null value is NaN. ``exact`` grows with 2**features; with many features ask for ``sampled`` coalitions.
    """
    names, kept = list(features), list(keys)
    shared = df.sparkSession.sparkContext.broadcast(CoalitionScores(None, background_values(background, names), method, coalitions))
    own = [f for f in names if f not in kept]
    schema = T.StructType(
        [df.schema[k] for k in kept]
        + [T.StructField(f, T.DoubleType()) for f in [*own, *[f"phi_{f}" for f in names], "base_value", "output"]]
    )
    columns = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The function travels with the task, so that it may come from anywhere.
        scores = shared.value
        scores.predict = predict
        for batch in batches:
            values = {f: batch.column(len(kept) + i) for i, f in enumerate(names)}
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in values.values()], axis=1)
            phi, base, output = scores.phi(x)
            parts = [*[batch.column(i) for i in range(len(kept))], *[values[f] for f in own]]
            yield pa.RecordBatch.from_arrays([*parts, *[pa.array(np.ascontiguousarray(c)) for c in (*phi.T, base, output)]], names=columns)

    inputs = df.select(*[quoted(k) for k in kept], *[quoted(f).cast("double").alias(f"_x{i}") for i, f in enumerate(names)])
    return Attribution(_spread(inputs).mapInArrow(run, schema), kept, names)


@dataclass
class LinearScore:
    """Array form of a linear model; ``target`` is the class whose probability is the score, None the value itself."""

    weights: np.ndarray
    intercepts: np.ndarray
    target: int | None = None

    def __call__(self, x: np.ndarray) -> np.ndarray:
        raw = x @ self.weights.T + self.intercepts
        if self.target is None:
            return raw[:, 0]
        if raw.shape[1] == 1:
            p = 1 / (1 + np.exp(-raw[:, 0]))
            return p if self.target == 1 else 1 - p
        raw = np.exp(raw - raw.max(axis=1, keepdims=True))
        return raw[:, self.target] / raw.sum(axis=1)


def array_form(model: Any, target_class: int = 1) -> LinearScore | None:
    """A Spark linear or logistic model as a function of arrays; None for other models."""
    if hasattr(model, "coefficientMatrix"):
        return LinearScore(model.coefficientMatrix.toArray(), model.interceptVector.toArray(), target_class)
    if hasattr(model, "coefficients"):
        return LinearScore(model.coefficients.toArray()[None, :], np.array([model.intercept]))
    return None


def attribute_model(
    trained: Any,
    df: DataFrame,
    keys: Sequence[str],
    background: DataFrame | None = None,
    target_class: int = 1,
    method: str = "exact",
) -> Attribution:
    """The method that fits the model family: linear, trees, else model-agnostic.

    Linear models and boosted trees are explained on the margin of ``target_class``, forests on its
    probability, other classifiers on that probability with ``background`` (by default a sample of
    BACKGROUND_ROWS rows by hash of their keys) and the coalitions of ``method``; those that have an array form are scored
    in arrays.
    """
    from tabweave.operators.models import with_probabilities
    from tabweave.operators.split import sample_n

    ready = trained.preparation.transform(df)
    given = None if background is None else trained.preparation.transform(background)
    model = trained.model.stages[-1]
    if hasattr(model, "models"):
        return tree_attribution(ready, keys, trained.features, model.models[target_class])
    if getattr(model, "numClasses", 2) == 2 and hasattr(model, "coefficients"):
        weights = dict(zip(trained.features, (float(w) for w in model.coefficients)))
        means = background_means(ready if given is None else given, trained.features)
        return linear_attribution(ready, keys, weights, float(model.intercept), means)
    if hasattr(model, "featureImportances"):
        return tree_attribution(ready, keys, trained.features, model, target_class)
    base = sample_n(ready, keys, BACKGROUND_ROWS) if given is None else given
    arrays = array_form(model, target_class)
    if arrays is not None:
        return array_attribution(ready, keys, trained.features, base, arrays, method)

    def score(rows: DataFrame) -> DataFrame:
        out, classes = with_probabilities(trained.model, rows)
        return out.withColumn("score", F.col("_proba")[target_class] if classes else F.col("prediction"))

    return kernel_attribution(ready, keys, trained.features, base, score, method=method)


def class_attributions(trained: Any, df: DataFrame, keys: Sequence[str], classes: int, **how: Any) -> DataFrame:
    """(keys, class, feature, feature_value, shap, base_value): one attribution for each class."""
    parts = []
    for c in range(classes):
        long = long_table(attribute_model(trained, df, keys, target_class=c, **how))
        parts.append(long.withColumn("class", F.lit(c)))
    return reduce(DataFrame.unionByName, parts)


# -------------------------------------------------------------------- reports


def long_table(a: Attribution) -> DataFrame:
    """(keys, feature, feature_value, shap, base_value): one row per row and feature."""
    entries = [
        F.struct(F.lit(f).alias("feature"), quoted(f).cast("double").alias("feature_value"), a.phi(f).alias("shap"))
        for f in a.features
    ]
    return a.df.select(*[quoted(k) for k in a.keys], F.inline(F.array(*entries)), "base_value")


def feature_stats(a: Attribution) -> DataFrame:
    """Per feature: mean |phi|, mean phi, population std and direction, in one pass."""
    aggs = []
    for i, f in enumerate(a.features):
        p = a.phi(f)
        aggs += [F.avg(F.abs(p)).alias(f"a{i}"), F.avg(p).alias(f"m{i}"), F.stddev_pop(p).alias(f"s{i}")]
    entries = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f"a{i}").alias("mean_abs_shap"),
            F.col(f"m{i}").alias("mean_shap"),
            F.col(f"s{i}").alias("std_shap"),
        )
        for i, f in enumerate(a.features)
    ]
    up = F.when(F.col("mean_shap") > 0, F.lit("up")).otherwise(F.lit("down"))
    return a.df.agg(*aggs).select(F.inline(F.array(*entries))).withColumn("direction", up)


def importance(a: Attribution, top: int | None = None) -> DataFrame:
    """Features ranked by mean |phi|; ties by name. One row per feature, so the rank is cheap."""
    order = Window.orderBy(F.desc("mean_abs_shap"), "feature")
    ranked = feature_stats(a).select(F.row_number().over(order).alias("rank"), "feature", "mean_abs_shap")
    return ranked if top is None else ranked.where(F.col("rank") <= top)


def top_features(a: Attribution, n: int) -> list[str]:
    rows = feature_stats(a).orderBy(F.desc("mean_abs_shap"), "feature").limit(n).collect()
    return [r["feature"] for r in rows]


def stats_report(a: Attribution, top: int = 20) -> DataFrame:
    return feature_stats(a).orderBy(F.desc("mean_abs_shap"), "feature").limit(top)


def waterfall(a: Attribution, rows: DataFrame | None = None, top: int = 20) -> DataFrame:
    """Per row the ``top`` features by |phi| in order, the rest summed as ``other``.

    Sorting happens inside each row, so this needs no shuffle.
    """
    df = a.df if rows is None else rows
    cells = F.array(
        *[
            F.struct(
                (-F.abs(a.phi(f))).alias("o"),
                F.lit(f).alias("feature"),
                a.phi(f).alias("shap"),
                quoted(f).cast("double").alias("feature_value"),
            )
            for f in a.features
        ]
    )
    ranked = df.select(*[quoted(k) for k in a.keys], "base_value", F.array_sort(cells).alias("_c"))
    shown = F.transform(
        F.slice("_c", 1, top),
        lambda c, i: F.struct((i + 1).alias("rank"), c["feature"].alias("feature"), c["shap"].alias("shap"), c["feature_value"].alias("feature_value")),
    )
    spare = max(len(a.features) - top, 0)
    if spare:
        tail = F.aggregate(F.slice("_c", top + 1, spare), F.lit(0.0), lambda s, c: s + c["shap"])
        other = F.struct(
            F.lit(top + 1).alias("rank"), F.lit("other").alias("feature"), tail.alias("shap"), F.lit(None).cast("double").alias("feature_value")
        )
        shown = F.concat(shown, F.array(other))
    return ranked.select(*[quoted(k) for k in a.keys], "base_value", F.inline(shown))


def dependence(a: Attribution, features: Sequence[str | int]) -> DataFrame:
    """(keys, feature, feature_value, shap) of the named features."""
    names = [a.features[f] if isinstance(f, int) else f for f in features]
    unknown = [f for f in names if f not in a.features]
    if unknown:
        raise ValueError(f"unknown features {unknown}")
    return long_table(Attribution(a.df, a.keys, names)).drop("base_value")


def distribution(a: Attribution, probs: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0), top: int = 20) -> DataFrame:
    """Exact quantiles of phi per feature for the top features; one row per feature."""
    names = top_features(a, top)
    quantiles = exact_quantiles(a.df, {f"phi_{f}": list(probs) for f in names})
    rows = [(i + 1, f, *quantiles[f"phi_{f}"]) for i, f in enumerate(names)]
    schema = "rank int, feature string, " + ", ".join(f"q{round(p * 100)} double" for p in probs)
    return a.df.sparkSession.createDataFrame(rows, schema)


def beeswarm(a: Attribution, top: int = 20) -> DataFrame:
    """All (feature, value, phi) points of the top features."""
    return long_table(Attribution(a.df, a.keys, top_features(a, top))).drop("base_value")


def force_rows(a: Attribution, n: int = 50) -> DataFrame:
    """Base, phi and value of the first n rows by key."""
    first = a.df.orderBy(*[quoted(k) for k in a.keys]).limit(n)
    return long_table(Attribution(first, a.keys, a.features))


def positive_class(long: DataFrame, class_column: str = "class") -> DataFrame:
    """The positive class of a table with one attribution per class."""
    return long.where(quoted(class_column) == 1).drop(class_column)


def split_importances(model: Any, features: Sequence[str]) -> DataFrame:
    """Importances the trees recorded while training."""
    values = model.featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return _session().createDataFrame(rows, "feature string, importance double")


def explain_all(a: Attribution, folder: str, top: int = 20) -> dict[str, str]:
    """Write all reports as Parquet tables; attributions are computed once."""
    from tabweave.sources.writers import write_tables

    spark = a.df.sparkSession
    values = f"{folder.rstrip('/')}/values"
    a.df.write.parquet(values)
    a = Attribution(spark.read.parquet(values), a.keys, a.features)
    first = a.df.orderBy(*[quoted(k) for k in a.keys]).limit(1)
    best = top_features(a, 1)
    paths = write_tables(
        {
            "importance": importance(a, top),
            "stats": stats_report(a, top),
            "summary": beeswarm(a, top),
            "waterfall": waterfall(a, first, top),
            "dependence": dependence(a, best),
            "force": force_rows(a, 1),
        },
        folder,
    )
    return {"values": values, **paths}
