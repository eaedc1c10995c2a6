"""Category dictionaries: fitted once, applied as CASE, broadcast join or hot-split join."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.functions.columns import nan_to_null, quoted, typed_lit
from tabweave.plans.lookup import key_bytes, lookup_join
from tabweave.plans.ordered import key_boundaries, prefix_sums
from tabweave.session import fresh_dir, written

CASE_KEYS = 64
DRIVER_KEYS = 50_000


@dataclass
class Dictionary:
    """Key -> number for one column. Many keys live in a table, few on the driver."""

    column: str
    key_type: T.DataType
    value_type: T.DataType
    default: float
    pairs: list[tuple[Any, Any]] | None = None
    table: str | None = None
    size: int = 0
    total: int = 0
    fill: str | None = None
    size_bytes: int = 0

    def _key(self) -> Column:
        key = quoted(self.column)
        if self.fill is not None:
            return F.coalesce(key.cast("string"), F.lit(self.fill))
        return key.cast(self.key_type)

    def apply(self, df: DataFrame, output: str | None = None) -> DataFrame:
        """Replace the column (or add ``output``); unseen and missing keys get the default."""
        out = output or self.column
        default = F.lit(self.default).cast(self.value_type)
        if self.pairs is not None and len(self.pairs) <= CASE_KEYS:
            coded: Column | None = None
            for k, v in self.pairs:
                hit = self._key() == typed_lit(k, self.key_type)
                val = F.lit(v).cast(self.value_type)
                coded = F.when(hit, val) if coded is None else coded.when(hit, val)
            coded = default if coded is None else coded.otherwise(default)
            return _put(df, out, coded)
        spark = df.sparkSession
        keyed = df.withColumn("_k", self._key())
        if self.pairs is not None:
            schema = T.StructType([T.StructField("_key", self.key_type), T.StructField("_v", self.value_type)])
            # Spark broadcasts these pairs if they are small.
            pairs = spark.createDataFrame(self.pairs, schema)
            joined = keyed.join(pairs, F.col("_k") == F.col("_key"), "left").drop("_key")
        else:
            joined = lookup_join(keyed, spark.read.parquet(self.table), "_k", self.size_bytes, self.total)
        coded = F.coalesce(F.col("_v"), default)
        return _put(joined.drop("_k"), out, coded, df.columns).drop("_v")

    def entries(self, spark: SparkSession) -> DataFrame:
        """The dictionary as a table (key, value)."""
        if self.pairs is not None:
            schema = T.StructType([T.StructField("key", self.key_type), T.StructField("value", self.value_type)])
            return spark.createDataFrame(self.pairs, schema)
        return spark.read.parquet(self.table).select(F.col("_key").alias("key"), F.col("_v").alias("value"))

    def to_dict(self) -> dict[str, Any]:
        return {
            "column": self.column,
            "key_type": self.key_type.simpleString(),
            "value_type": self.value_type.simpleString(),
            "default": self.default,
            "pairs": None if self.pairs is None else [[_plain(k), v] for k, v in self.pairs],
            "table": self.table,
            "size": self.size,
            "total": self.total,
            "fill": self.fill,
            "size_bytes": self.size_bytes,
        }

    @staticmethod
    def from_dict(d: dict[str, Any]) -> "Dictionary":
        kinds = {k: T.StructType.fromDDL(f"x {d[k]}")["x"].dataType for k in ("key_type", "value_type")}
        pairs = None if d["pairs"] is None else [tuple(p) for p in d["pairs"]]
        return Dictionary(**{**d, **kinds, "pairs": pairs})


def _plain(k: Any) -> Any:
    return k if isinstance(k, (str, int, float, bool)) or k is None else str(k)


def _put(df: DataFrame, name: str, value: Column, order: Sequence[str] | None = None) -> DataFrame:
    names = list(order or df.columns)
    cols = [value.alias(name) if c == name else quoted(c) for c in names]
    if name not in names:
        cols.append(value.alias(name))
    return df.select(*cols)


def cells(df: DataFrame, columns: Sequence[str], *more: Column) -> list[DataFrame]:
    """The columns as rows (name, value, ...), one table for each type among them; NaN is null.

    One pass over the rows then serves all columns of a type.
    """
    by_type: dict[str, list[str]] = {}
    for c in columns:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    out = []
    for kind, names in by_type.items():
        value = (lambda c: nan_to_null(quoted(c))) if kind in ("float", "double") else quoted
        entries = F.array(*[F.struct(F.lit(c).alias("name"), value(c).alias("value")) for c in names])
        out.append(df.select(F.inline(entries), *more).where("value IS NOT NULL"))
    return out


def distinct_sizes(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Estimated number of values per column; decides on how to compute, never on results."""
    row = df.agg(*[F.approx_count_distinct(quoted(c)) for c in columns]).first()
    return dict(zip(columns, row))


def columns_up_to(df: DataFrame, columns: Sequence[str], most: int) -> list[str]:
    """The columns with at most so many values, exactly. Those estimated at twice as many are not counted."""
    if not columns:
        return []
    estimate = distinct_sizes(df, columns)
    near = [c for c in columns if estimate[c] <= 2 * most + 10]
    found: dict[str, int] = {c: 0 for c in near}
    for part in cells(df, near):
        for r in part.distinct().groupBy("name").agg(F.count("*").alias("n")).collect():
            found[r["name"]] = r["n"]
    return [c for c in columns if c in found and found[c] <= most]


def category_values(df: DataFrame, columns: Sequence[str]) -> dict[str, list[Any]]:
    """Sorted distinct values per column, missing ones left out; they end up on the driver."""
    values: dict[str, list[Any]] = {c: [] for c in columns}
    for part in cells(df, columns):
        for r in part.distinct().toLocalIterator():
            values[r["name"]].append(r["value"])
    return {c: sorted(vs) for c, vs in values.items()}


def fit_sorted_codes(
    df: DataFrame,
    columns: Sequence[str],
    known: dict[str, Sequence[Any]] | None = None,
    fill: str | None = None,
    driver_keys: int = DRIVER_KEYS,
    one_task_keys: int | None = None,
) -> dict[str, Dictionary]:
    """Dense codes 0..k-1 by sorted value; missing -> -1, or ``fill`` counted as a value.

    ``known`` gives ordered categories (from binning) that keep their own order.
    """
    known = known or {}
    keyed = df.select(
        *[
            (F.coalesce(quoted(c).cast("string"), F.lit(fill)) if fill is not None else quoted(c)).alias(c)
            for c in columns
        ]
    )
    todo = [c for c in columns if c not in known]
    sizes = distinct_sizes(keyed, todo) if todo else {}
    small = [c for c in todo if sizes[c] <= driver_keys]
    values = {**{c: list(known[c]) for c in columns if c in known}, **category_values(keyed, small)}
    out = {}
    for c in columns:
        kind = keyed.schema[c].dataType
        if c in values:
            pairs = [(v, i) for i, v in enumerate(values[c])]
            out[c] = Dictionary(c, kind, T.LongType(), -1, pairs, size=len(pairs), fill=fill)
            continue
        groups = keyed.where(quoted(c).isNotNull()).groupBy(quoted(c).alias("_key")).agg(F.count("*").alias("_n"))
        bounds = key_boundaries(keyed, c, one_task_keys, sizes[c])
        codes = prefix_sums(groups.withColumn("_one", F.lit(1)), "_key", ["_one"], bounds)
        out[c] = _as_table(codes, F.col("_one_before"), c, kind, T.LongType(), -1, fill)
    return out


def _grouped(df: DataFrame, columns: Sequence[str], more: Column, aggregate: Column, driver_keys: int) -> dict[str, Any]:
    """Per column its values with an aggregate ``_a`` and their rows ``_n``: a list on the driver, or a table if many.

    All columns of a type are grouped in one pass; the groups are written before they are read by column.
    """
    out: dict[str, Any] = {c: [] for c in columns}
    for part in cells(df, columns, more):
        groups = part.groupBy("name", "value").agg(aggregate.alias("_a"), F.count("*").alias("_n"))
        groups = written(groups, "groups")
        sizes = {r["name"]: r["n"] for r in groups.groupBy("name").agg(F.count("*").alias("n")).collect()}
        small = [c for c, n in sizes.items() if n <= driver_keys]
        for r in groups.where(F.col("name").isin(small)).collect() if small else []:
            out[r["name"]].append((r["value"], r["_a"]))
        for c in sizes:
            if c not in small:
                out[c] = groups.where(F.col("name") == c).select(F.col("value").alias("_key"), "_a", "_n")
    return out


def fit_first_seen_codes(
    df: DataFrame, columns: Sequence[str], order_by: str, driver_keys: int = DRIVER_KEYS
) -> dict[str, Dictionary]:
    """Codes by first appearance along ``order_by``; missing -> -1."""
    groups = _grouped(df, columns, quoted(order_by).alias("_at"), F.min("_at"), driver_keys)
    out = {}
    for c in columns:
        kind = df.schema[c].dataType
        if isinstance(groups[c], list):
            ordered = sorted(groups[c], key=lambda p: (p[1], p[0]))
            pairs = [(k, i) for i, (k, _) in enumerate(ordered)]
            out[c] = Dictionary(c, kind, T.LongType(), -1, pairs, size=len(pairs))
            continue
        bounds = key_boundaries(df, order_by)
        firsts = groups[c].withColumnRenamed("_a", "_first").withColumn("_one", F.lit(1))
        codes = prefix_sums(firsts, "_first", ["_one"], bounds, then=["_key"])
        out[c] = _as_table(codes, F.col("_one_before"), c, kind, T.LongType(), -1, None)
    return out


def fit_target_means(
    df: DataFrame, columns: Sequence[str], label: str, driver_keys: int = DRIVER_KEYS
) -> dict[str, Dictionary]:
    """Mean label per category; unseen and missing -> the overall mean."""
    y = quoted(label).cast("double")
    whole = df.agg(F.avg(y)).first()[0]
    groups = _grouped(df, columns, y.alias("_y"), F.avg("_y"), driver_keys)
    out = {}
    for c in columns:
        kind = df.schema[c].dataType
        if isinstance(groups[c], list):
            pairs = sorted(groups[c])
            out[c] = Dictionary(c, kind, T.DoubleType(), whole, pairs, size=len(pairs))
        else:
            out[c] = _as_table(groups[c], F.col("_a"), c, kind, T.DoubleType(), whole, None)
    return out


def out_of_fold_means(
    df: DataFrame, columns: Sequence[str], label: str, fold: Column, smoothing: float = 0.0, suffix: str = "_te"
) -> DataFrame:
    """Rows with a column of target means for each of ``columns`` in which no row's own label takes part.

    ``fold`` is a number of few values, for instance a hash bucket of the key. A row sees the sum and the count of its
    category over all folds but its own, smoothed by ``smoothing`` rows of the mean of those folds. A missing category, one
    seen in the row's own fold only, and a null label count as what they are: the mean of the other folds, and no label.
    With a single fold that mean is null. Rows to score take the dictionaries of `fit_target_means` instead.

    One pass sums by category and fold, with partial sums on the map side; the result has folds rows per category and is
    joined by `lookup_join`, so that a category which a third of the rows share is broadcast and never shuffled.
    """
    y, made = quoted(label).cast("double"), [f"{c}{suffix}" for c in columns]
    clash = set(made) & set(df.columns)
    if clash:
        raise ValueError(f"columns exist already: {', '.join(sorted(clash))}")
    marked = df.withColumn("_fold", fold.cast("int"))
    totals = marked.groupBy("_fold").agg(F.sum(y).alias("s"), F.count(y).alias("n")).collect()
    s_all, n_all = sum(r["s"] or 0.0 for r in totals), sum(r["n"] for r in totals)
    prior: Column = F.lit(None).cast("double")
    for r in totals:
        rest = n_all - r["n"]
        mean = (s_all - (r["s"] or 0.0)) / rest if rest else None
        prior = F.when(F.col("_fold").eqNullSafe(F.lit(r["_fold"])), F.lit(mean).cast("double")).otherwise(prior)
    out = marked
    for part in cells(marked, columns, y.alias("_y"), F.col("_fold")):
        sums = written(part.groupBy("name", "value", "_fold").agg(F.sum("_y").alias("s"), F.count("_y").alias("n"), F.count("*").alias("_n")), "folds")
        both = sums.groupBy("name", "value").agg(F.sum("s").alias("sa"), F.sum("n").alias("na"))
        at = ["name", "value"]
        rest = sums.join(both, at).select(*at, "_fold", "_n", (F.col("sa") - F.coalesce("s", F.lit(0.0))).alias("s"), (F.col("na") - F.col("n")).alias("n"))
        rest = written(rest, "folds")
        for c in sorted({r["name"] for r in rest.select("name").distinct().collect()}):
            of_c = rest.where(F.col("name") == c).select(_fold_key(F.col("value"), df.schema[c].dataType), F.struct("s", "n").alias("_v"), "_n")
            size, total = key_bytes(of_c), of_c.agg(F.sum("_n")).first()[0]
            keyed = out.withColumn("_at", _fold_key(quoted(c), df.schema[c].dataType))
            out = lookup_join(keyed, of_c, "_at", size, total).drop("_at").withColumnRenamed("_v", f"{c}{suffix}")
    none = F.lit(None).cast("struct<s:double,n:bigint>")
    m = F.lit(float(smoothing))
    values = []
    for c, name in zip(columns, made):
        v = quoted(name) if name in out.columns else none
        weighed = F.when(m > 0, m * prior).otherwise(F.lit(0.0))
        values.append(F.coalesce(F.try_divide(v["s"] + weighed, v["n"] + m), prior).alias(name))
    return out.select(*[quoted(c) for c in df.columns], *values)


def _fold_key(value: Column, kind: T.DataType) -> Column:
    """Fold and category as one text; null without a category. NaN is no category, and -0.0 is 0.0."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = nan_to_null(value) + F.lit(0).cast(kind)
    return F.when(value.isNotNull(), F.to_json(F.struct("_fold", value.alias("value")))).alias("_key")


def _as_table(
    codes: DataFrame, value: Column, column: str, kind: T.DataType, value_type: T.DataType, default, fill
) -> Dictionary:
    """Write a large dictionary once to the shared folder, so that later use reads it back."""
    spark = codes.sparkSession
    path = fresh_dir(spark, "dictionary")
    codes.select("_key", value.cast(value_type).alias("_v"), F.col("_n").cast("bigint").alias("_n")).write.parquet(path)
    size, total = spark.read.parquet(path).agg(F.count("*"), F.sum("_n")).first()
    return Dictionary(column, kind, value_type, default, None, path, size, total, fill, key_bytes(spark.read.parquet(path)))
