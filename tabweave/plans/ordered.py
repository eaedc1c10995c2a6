"""Ordered computations without a single-task sort.

Three building blocks:

* ``prefix_sums``      running totals over a sorted key, one task per key range
* ``exact_quantiles``  interpolated quantiles by narrowing brackets, one pass for all columns
* ``rank_cutoffs``     the k-th smallest hash per class by a histogram of hash prefixes

What reaches the driver is bounded in each: boundaries, counters, or at most
``FETCH_ROWS`` values. Every pass is an aggregation with map-side combine.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import Any

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.functions.columns import NUMERIC_TYPES, hash_key, quoted, typed_lit

FETCH_ROWS = 200_000
ONE_TASK_KEYS = 200_000
NUMBER_RANGES = 2048
OTHER_RANGES = 256
HASH_BITS = 60


# ---------------------------------------------------------------- key ranges


def key_boundaries(
    df: DataFrame, column: str, one_task_keys: int | None = None, distinct: int | None = None
) -> list[Any]:
    """Boundaries that cut the distinct values of a column into even ranges.

    Distinct values, not rows, are balanced, so a hot value does not matter: callers
    aggregate by value first. The sample is a slice of the value hash and only decides
    where to cut, never which rows count. No boundaries means one range is enough.
    ``distinct`` is the estimated number of values, if the caller has it already.
    """
    limit = one_task_keys or ONE_TASK_KEYS
    if distinct is None:
        distinct = df.agg(F.approx_count_distinct(quoted(column))).first()[0]
    if distinct <= limit:
        return []
    most = NUMBER_RANGES if isinstance(df.schema[column].dataType, NUMERIC_TYPES) else OTHER_RANGES
    ranges = min(most, max(2, math.ceil(4 * distinct / limit)))
    slices = max(1, distinct // (32 * ranges))
    sample = (
        df.select(quoted(column).alias("v"))
        .where(F.col("v").isNotNull() & (F.pmod(F.xxhash64("v"), F.lit(slices)) == 0))
        .distinct()
        .limit(FETCH_ROWS)
        .collect()
    )
    values = sorted(r[0] for r in sample if r[0] == r[0])
    if len(values) < ranges:
        return values
    return [values[len(values) * i // ranges] for i in range(1, ranges)]


def with_range(df: DataFrame, key: str, bounds: Sequence[Any], output: str = "_range") -> DataFrame:
    """Add the number of boundaries <= key. It never falls as the key grows."""
    if not bounds:
        return df.withColumn(output, F.lit(0))
    if isinstance(df.schema[key].dataType, NUMERIC_TYPES):
        # A long key may lose digits as a double, but equal keys stay together and the order holds.
        cuts = sorted({float(b) for b in bounds})
        splits = [-math.inf, *cuts, math.inf]
        keyed = df.withColumn("_bucketed", quoted(key).cast("double"))
        ranged = Bucketizer(splits=splits, inputCol="_bucketed", outputCol=output, handleInvalid="keep").transform(keyed)
        return ranged.withColumn(output, quoted(output).cast("int")).drop("_bucketed")

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(quoted(key) < typed_lit(bounds[mid], df.schema[key].dataType), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return df.withColumn(output, tree(0, len(bounds)))


def prefix_sums(
    groups: DataFrame,
    key: str,
    sums: Sequence[str],
    bounds: Sequence[Any],
    by: Sequence[str] = (),
    then: Sequence[str] = (),
) -> DataFrame:
    """Add ``{s}_before``: the total of s over all smaller keys (within ``by``).

    ``groups`` holds one row per (by, key, then); ``then`` breaks ties of the key. Each range is sorted by its own task; range
    totals, one per range and ``by`` value, carry the offset.
    """
    ranged = with_range(groups, key, bounds)
    inside = Window.partitionBy(*by, "_range").orderBy(quoted(key), *[quoted(t) for t in then])
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select(
        "*", *[(F.sum(quoted(s)).over(inside) - quoted(s)).alias(f"{s}_before") for s in sums]
    )
    if not bounds:
        return local.drop("_range")
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*by, "_range")
        .agg(*[F.sum(quoted(s)).alias(f"_t_{s}") for s in sums])
        .select(
            *[F.col(b).alias(f"_by_{b}") for b in by],
            F.col("_range").alias("_r"),
            *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums],
        )
    )
    match = F.col("_range") == F.col("_r")
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    joined = local.join(offsets, match, "left")
    kept = [quoted(c) for c in groups.columns]
    return joined.select(
        *kept, *[(F.col(f"{s}_before") + F.col(f"_o_{s}")).alias(f"{s}_before") for s in sums]
    )


# ----------------------------------------------------------------- quantiles

SKETCH_ACCURACY = 10_000
SKETCH_MARGIN = 1e-3


@dataclass
class _Bracket:
    """Values lo..hi of a column that should hold the value at a 0-based rank.

    ``outer`` is the smallest range proven to hold it; after a sketch missed, the next
    bracket is halved by value instead.
    """

    column: str
    rank: int
    lo: float
    hi: float
    outer: tuple[float, float] = (-math.inf, math.inf)
    halve: bool = False


def exact_quantiles(
    df: DataFrame, wanted: dict[str, Sequence[float]], fetch_rows: int | None = None
) -> dict[str, list[float | None]]:
    """Exact, linearly interpolated quantiles of numeric columns; nulls and NaN ignored.

    A sketch brackets each rank; counting proves the brackets, all in one pass; a bracket
    with few rows or few distinct values is fetched as value counts, a wider one is narrowed
    again. A short column goes through ``percentile``, one counter per distinct value.
    """
    if not wanted:
        return {}
    limit = fetch_rows or FETCH_ROWS
    vals = df.select(*[_clean(c).alias(c) for c in wanted])
    aggs = []
    for i, (c, probs) in enumerate(wanted.items()):
        v = quoted(c)
        around = [min(max(p + d, 0.0), 1.0) for p in probs for d in (-SKETCH_MARGIN, SKETCH_MARGIN)]
        aggs += [
            F.count(v).alias(f"n{i}"),
            F.min(v).alias(f"lo{i}"),
            F.max(v).alias(f"hi{i}"),
            F.approx_count_distinct(v).alias(f"d{i}"),
            F.percentile_approx(v, around, SKETCH_ACCURACY).alias(f"q{i}"),
        ]
    row = vals.agg(*aggs).first()
    out: dict[str, list[float | None]] = {}
    short: list[str] = []
    spots: dict[str, list[float]] = {}
    todo: dict[tuple[str, int], _Bracket] = {}
    ends: dict[str, tuple[float, float]] = {}
    coarse: set[str] = set()
    known: dict[tuple[str, int], float] = {}
    for i, (c, probs) in enumerate(wanted.items()):
        n = row[f"n{i}"]
        if n == 0:
            out[c] = [None] * len(probs)
        elif n <= limit // 2:
            short.append(c)
        else:
            ends[c] = (row[f"lo{i}"], row[f"hi{i}"])
            if row[f"d{i}"] <= limit // 2:
                coarse.add(c)
            spots[c] = [p * (n - 1) for p in probs]
            for k, (p, spot) in enumerate(zip(probs, spots[c])):
                near = row[f"q{i}"][2 * k : 2 * k + 2]
                # The outermost brackets reach to the ends, where the sketch may stop short.
                lo = ends[c][0] if p <= SKETCH_MARGIN else near[0]
                hi = ends[c][1] if p >= 1 - SKETCH_MARGIN else near[1]
                for rank in {math.floor(spot), math.ceil(spot)} - {0, n - 1}:
                    todo[c, rank] = _Bracket(c, rank, lo, hi, ends[c])
                known[c, 0], known[c, n - 1] = ends[c]
    if short:
        got = vals.agg(
            *[F.percentile(quoted(c), F.array(*[F.lit(float(p)) for p in wanted[c]])) for c in short]
        ).first()
        out.update({c: list(qs) for c, qs in zip(short, got)})
    found = known | _values_at_ranks(vals, list(todo.values()), coarse, limit)
    for c, at in spots.items():
        out[c] = []
        for spot in at:
            a, b = found[c, math.floor(spot)], found[c, math.ceil(spot)]
            # Between equal ends, also infinite ones, nothing is interpolated.
            out[c].append(a if a == b else a + (b - a) * (spot - math.floor(spot)))
    return {c: out[c] for c in wanted}


def _clean(column: str) -> Column:
    v = quoted(column).cast("double")
    return F.when(~F.isnan(v), v)


def _values_at_ranks(
    vals: DataFrame, todo: list[_Bracket], coarse: set[str], limit: int
) -> dict[tuple[str, int], float]:
    """The value at each rank. Columns in ``coarse`` are known to have few distinct values."""
    found: dict[tuple[str, int], float] = {}
    for _ in range(256):
        if not todo:
            return found
        share = limit // len(todo) + 1
        ready: list[tuple[_Bracket, int]] = []
        wide: list[tuple[_Bracket, int, int]] = []
        missed: list[_Bracket] = []
        for b, (below, inside) in zip(todo, _count_brackets(vals, todo)):
            if not below <= b.rank < below + inside:
                # The sketch missed the rank: search the side that must hold it.
                lo, hi = (b.outer[0], b.lo) if b.rank < below else (b.hi, b.outer[1])
                missed.append(_Bracket(b.column, b.rank, lo, hi, (lo, hi), True))
            elif b.lo == b.hi:
                found[b.column, b.rank] = b.lo
            elif b.column in coarse or inside <= share:
                ready.append((b, below))
            else:
                wide.append((b, below, inside))
        narrowed, settled = _narrow(vals, wide, share)
        _fetch_brackets(vals, ready + settled, found)
        todo = missed + narrowed
    raise RuntimeError("quantile brackets did not converge")


def _inside(b: _Bracket) -> Column:
    return (quoted(b.column) >= F.lit(b.lo)) & (quoted(b.column) <= F.lit(b.hi))


def _spans(brackets: Sequence[_Bracket]) -> list[tuple[str, float, float]]:
    return sorted({(b.column, b.lo, b.hi) for b in brackets})


def _count_brackets(vals: DataFrame, brackets: list[_Bracket]) -> list[tuple[int, int]]:
    """Rows below and rows inside each bracket, counted in one pass."""
    spans = _spans(brackets)
    aggs = []
    for i, (c, lo, hi) in enumerate(spans):
        aggs += [
            F.count_if(quoted(c) < F.lit(lo)).alias(f"b{i}"),
            F.count_if(_inside(_Bracket(c, 0, lo, hi))).alias(f"i{i}"),
        ]
    row = vals.agg(*aggs).first()
    got = {s: (row[f"b{i}"], row[f"i{i}"]) for i, s in enumerate(spans)}
    return [got[b.column, b.lo, b.hi] for b in brackets]


def _fetch_brackets(vals: DataFrame, ready: list[tuple[_Bracket, int]], found: dict) -> None:
    """Value counts of all given brackets in one job; their sizes were checked."""
    if not ready:
        return
    spans = _spans([b for b, _ in ready])
    hits = F.array(
        *[
            F.when(_inside(_Bracket(c, 0, lo, hi)), F.struct(F.lit(i).alias("i"), quoted(c).alias("v")))
            for i, (c, lo, hi) in enumerate(spans)
        ]
    )
    some = reduce(or_, [_inside(_Bracket(c, 0, lo, hi)) for c, lo, hi in spans])
    cells = vals.where(some).select(F.explode(hits).alias("h")).where(F.col("h").isNotNull())
    rows = cells.groupBy("h.i", "h.v").agg(F.count("*").alias("n")).collect()
    held: dict[int, list[tuple[float, int]]] = {}
    for r in rows:
        held.setdefault(r["i"], []).append((r["v"], r["n"]))
    place = {s: i for i, s in enumerate(spans)}
    for b, below in ready:
        at = below
        for v, k in sorted(held[place[b.column, b.lo, b.hi]]):
            if at <= b.rank < at + k:
                found[b.column, b.rank] = v
                break
            at += k
        else:
            raise RuntimeError(f"rank {b.rank} of {b.column} is outside its bracket")


def _narrow(
    vals: DataFrame, wide: list[tuple[_Bracket, int, int]], share: int
) -> tuple[list[_Bracket], list[tuple[_Bracket, int]]]:
    """Smaller brackets, from a sketch of only the values inside; and brackets with few values."""
    if not wide:
        return [], []
    aggs = []
    for i, (b, below, inside) in enumerate(wide):
        at = (b.rank - below) / max(inside - 1, 1)
        probs = [max(at - SKETCH_MARGIN, 0.0), min(at + SKETCH_MARGIN, 1.0)]
        v = quoted(b.column)
        held = F.when(_inside(b), v)
        middle = F.lit(b.lo / 2 + b.hi / 2)
        aggs += [
            F.percentile_approx(held, probs, SKETCH_ACCURACY).alias(f"q{i}"),
            F.approx_count_distinct(held).alias(f"d{i}"),
            F.count_if(held <= middle).alias(f"m{i}"),
            F.max(F.when(held <= middle, v)).alias(f"l{i}"),
            F.min(F.when(held > middle, v)).alias(f"r{i}"),
        ]
    row = vals.agg(*aggs).first()
    narrowed, settled = [], []
    for i, (b, below, inside) in enumerate(wide):
        lo, hi = row[f"q{i}"]
        if row[f"d{i}"] <= share // 2:
            settled.append((b, below))
        elif b.halve or (lo, hi) == (b.lo, b.hi):
            lo, hi = (b.lo, row[f"l{i}"]) if b.rank < below + row[f"m{i}"] else (row[f"r{i}"], b.hi)
            narrowed.append(_Bracket(b.column, b.rank, lo, hi, (lo, hi)))
        else:
            narrowed.append(_Bracket(b.column, b.rank, lo, hi, (b.lo, b.hi)))
    return narrowed, settled


# ------------------------------------------------------------- hash cutoffs


CUTOFF_ROWS = 20_000


@dataclass(frozen=True)
class RowOrder:
    """A reproducible random order of rows: by a hash of the key columns, then by the keys.

    The keys must identify a row. ``hashed`` names the keys that the hash is of, if not all. ``md5`` gives the same order in any SQL engine;
    ``xxhash64`` costs a fraction of it and exists only in Spark.
    """

    keys: Sequence[str]
    seed: int = 42
    method: str = "md5"
    hashed: Sequence[str] | None = None

    def column(self) -> Column:
        h = hash_key([quoted(k) for k in self.hashed or self.keys], self.seed, self.method)
        return F.struct(h.alias("_hash"), *[quoted(k).alias(k) for k in self.keys])


@dataclass
class Cutoffs:
    """Per class, the order keys (hash, key columns) that close each block of rows."""

    classes: dict[Any, int]
    points: dict[Any, list[tuple | None]]
    order_type: T.StructType
    class_type: T.DataType | None


@dataclass
class _Target:
    cls: Any
    slot: int
    rank: int
    lo: int
    hi: int
    n: int


def rank_cutoffs(
    df: DataFrame,
    order: RowOrder,
    ranks_of: Callable[[dict[Any, int]], dict[Any, list[int]]],
    class_column: str | None = None,
    fetch_rows: int | None = None,
) -> Cutoffs:
    """For each class, the order key of the row with each wanted rank (1-based; 0 = none).

    ``ranks_of`` turns class counts into wanted ranks. A range of hashes that still holds
    many rows is split by a histogram of the next bits; only the last, narrow ranges are read.
    The driver holds one count and its cutoffs per class, so a column with a value per row is no class.
    """
    cls = quoted(class_column) if class_column else F.lit(0)
    rows = df.select(cls.alias("y"), order.column().alias("o"))
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    ranks = ranks_of(counts)
    points: dict[Any, list[tuple | None]] = {y: [None] * len(rs) for y, rs in ranks.items()}
    todo = [
        _Target(y, i, r, 0, 1 << HASH_BITS, counts[y])
        for y, rs in ranks.items()
        for i, r in enumerate(rs)
        if r > 0
    ]
    order_type = rows.schema["o"].dataType
    class_type = rows.schema["y"].dataType if class_column else None
    if todo:
        limit = max(100, (fetch_rows or CUTOFF_ROWS) // len(todo))
        for _ in range(HASH_BITS):
            wide = [t for t in todo if t.n > limit and t.hi - t.lo > 1]
            if not wide:
                break
            _split_ranges(rows, wide)
        for t, point in _read_ranges(rows, todo):
            points[t.cls][t.slot] = point
    return Cutoffs(counts, points, order_type, class_type)


def _in_ranges(rows: DataFrame, targets: list[_Target]) -> DataFrame:
    """The rows inside the targets' hash ranges, marked with the range."""
    h = F.col("o._hash")
    if all(t.cls == 0 for t in targets) and isinstance(rows.schema["y"].dataType, T.IntegerType) and not rows.schema["y"].nullable:
        # Without classes the few ranges are literals.
        ranges = F.array(*[F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for lo, hi in sorted({(t.lo, t.hi) for t in targets})])
        held = F.filter(ranges, lambda s: (h >= s["lo"]) & (h < s["hi"]))
        return rows.select("y", "o", F.inline(held))
    schema = T.StructType(
        [
            T.StructField("ty", rows.schema["y"].dataType),
            T.StructField("lo", T.LongType()),
            T.StructField("hi", T.LongType()),
        ]
    )
    spans = sorted({(t.cls, t.lo, t.hi) for t in targets}, key=repr)
    # One row per class and block, which the driver holds; Spark broadcasts it by its size.
    table = rows.sparkSession.createDataFrame(spans, schema)
    return rows.join(table, F.col("y").eqNullSafe(F.col("ty")) & (h >= F.col("lo")) & (h < F.col("hi")))


def _split_ranges(rows: DataFrame, wide: list[_Target]) -> None:
    bits = 16 if len(wide) <= 4 else 10 if len(wide) <= 100 else 4
    step = {(t.cls, t.lo, t.hi): max(1, (t.hi - t.lo) >> bits) for t in wide}
    # Whole-number division: as doubles, hashes of 60 bits would lose their last digits.
    part = F.expr(f"(o._hash - lo) div greatest(shiftright(hi - lo, {bits}), 1)")
    hist: dict[tuple, dict[int, int]] = {}
    for r in _in_ranges(rows, wide).groupBy("y", "lo", "hi", part.alias("p")).count().collect():
        hist.setdefault((r["y"], r["lo"], r["hi"]), {})[r["p"]] = r["count"]
    for t in wide:
        span = (t.cls, t.lo, t.hi)
        at, width_ = 0, step[span]
        for p in sorted(hist[span]):
            k = hist[span][p]
            if at + k >= t.rank:
                t.rank -= at
                t.n = k
                t.lo, t.hi = t.lo + p * width_, min(t.lo + (p + 1) * width_, t.hi)
                break
            at += k


def _read_ranges(rows: DataFrame, todo: list[_Target]):
    """The order key at each target's rank. Equal order keys arrive as one row with a count."""
    held: dict[tuple, list[tuple]] = {}
    for r in _in_ranges(rows, todo).groupBy("y", "lo", "hi", "o").agg(F.count("*").alias("n")).collect():
        held.setdefault((r["y"], r["lo"], r["hi"]), []).append((tuple(r["o"]), r["n"]))
    for v in held.values():
        v.sort(key=lambda e: tuple((x is not None, x) for x in e[0]))
    for t in todo:
        at = 0
        for point, n in held[t.cls, t.lo, t.hi]:
            at += n
            if at >= t.rank:
                yield t, point
                break


def blocks_before(df: DataFrame, cut: Cutoffs, order: RowOrder, class_column: str | None = None) -> DataFrame:
    """Add ``_block``: how many cutoffs of its class a row lies beyond.

    The cutoff table has one row per class; Spark broadcasts it if it is small.
    """
    if class_column is None:
        out = F.lit(0)
        for p in cut.points.get(0, []):
            out = out + (F.lit(1) if p is None else (F.col("_o") > _literal(p, cut.order_type)).cast("int"))
        return df.withColumn("_o", order.column()).withColumn("_block", out).drop("_o")
    width = max((len(p) for p in cut.points.values()), default=0)
    names = [f"_c{i}" for i in range(width)]
    schema = T.StructType(
        [T.StructField("_y", cut.class_type)] + [T.StructField(c, cut.order_type) for c in names]
    )
    table = df.sparkSession.createDataFrame([(y, *p) for y, p in cut.points.items()], schema)
    joined = df.withColumn("_o", order.column()).join(
        table, quoted(class_column).eqNullSafe(F.col("_y")), "left"
    )
    out = F.lit(0)
    for c in names:
        out = out + F.when(F.col(c).isNull(), F.lit(1)).otherwise((F.col("_o") > F.col(c)).cast("int"))
    return joined.withColumn("_block", out).drop("_y", "_o", *names)


def _literal(values: tuple, kind: T.StructType) -> Column:
    return F.struct(*[typed_lit(v, f.dataType).alias(f.name) for v, f in zip(values, kind.fields)])


def take_smallest(df: DataFrame, order: RowOrder, n: int) -> DataFrame:
    """Exactly min(n, rows) rows, the first in the given order; a filter, whatever n is."""
    return take_by_class(df, order, F.lit(0), lambda counts: {y: min(n, k) for y, k in counts.items()})


def take_by_class(df: DataFrame, order: RowOrder, cls: Column, wanted_of: Callable[[dict[Any, int]], dict[Any, int]]) -> DataFrame:
    """Of each class (an int) so many rows as ``wanted_of`` makes of the counts of all classes, the first in the order.

    One search serves all classes. Rows with equal keys are ordered by a hash of all their columns. Rows that agree in that
    too are equal, so of those at a cutoff one is taken as often as rows are still wanted.
    """
    names = [quoted(c) for c in df.columns]
    marked = df.withColumn("_row", F.xxhash64(*names)).withColumn("_cls", cls.cast("int"))
    by_row = RowOrder([*order.keys, "_row"], order.seed, order.method, tuple(order.keys))
    cut = rank_cutoffs(marked, by_row, lambda c: {y: [k] for y, k in wanted_of(c).items() if k}, "_cls")
    if not cut.points:
        return df.limit(0)
    wanted = wanted_of(cut.classes)
    placed = marked.withColumn("_o", by_row.column())
    lasts = {y: _literal(points[0], cut.order_type) for y, points in cut.points.items()}
    at = {y: F.col("_cls").eqNullSafe(F.lit(y)) & (F.col("_o") == last) for y, last in lasts.items()}
    before = {y: F.col("_cls").eqNullSafe(F.lit(y)) & (F.col("_o") < last) for y, last in lasts.items()}
    counted = placed.agg(*[F.count_if(c) for y in lasts for c in (before[y], at[y])]).first()
    left = {y: wanted[y] - counted[2 * i] for i, y in enumerate(lasts)}
    whole = {y: left[y] == counted[2 * i + 1] for i, y in enumerate(lasts)}
    taken = reduce(or_, [before[y] | at[y] if whole[y] else before[y] for y in lasts])
    out = placed.where(taken).select(*names)
    for y in lasts:
        if not whole[y]:
            copies = placed.where(at[y]).limit(1).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(left[y]))))
            out = out.unionByName(copies.select(*names))
    return out
