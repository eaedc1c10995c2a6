"""Cleaning and profiling of a flat table: nulls, duplicates, casts, imputation, summaries."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.config import ValidationConfig
from tabweave.functions.columns import DATE_FORMATS, NUMERIC_TYPES, nan_to_null, quoted, timestamp_of
from tabweave.plans.ordered import exact_quantiles
from tabweave.session import written

# Names a target column may have instead of the wanted one, in this order.
TARGET_ALIASES = ("CVD_RISK", "target", "label", "y")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.CharType, T.VarcharType))]


def boolean_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]


def date_columns(df: DataFrame) -> list[str]:
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def dtype_counts(df: DataFrame) -> dict[str, int]:
    out: dict[str, int] = {}
    for f in df.schema.fields:
        name = f.dataType.simpleString()
        out[name] = out.get(name, 0) + 1
    return out


def normalise_missing(df: DataFrame) -> DataFrame:
    """NaN becomes null on float columns, so one notion of missing holds everywhere."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    if not floats:
        return df
    return df.select(*[nan_to_null(quoted(c)).alias(c) if c in floats else quoted(c) for c in df.columns])


def drop_columns(df: DataFrame, names: Sequence[str] | None) -> DataFrame:
    """Drop the listed columns that exist, by exact name."""
    gone = set(names or ())
    return df.select(*[quoted(c) for c in df.columns if c not in gone])


def features_and_label(df: DataFrame, label: str) -> tuple[list[str], str]:
    require_columns(df, [label])
    return [c for c in df.columns if c != label], label


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} not found; available: {df.columns}")


def rename_target(df: DataFrame, target: str, aliases: Sequence[str] = TARGET_ALIASES) -> DataFrame:
    if target in df.columns:
        return df
    for a in aliases:
        if a in df.columns:
            return df.select(*[quoted(c).alias(target) if c == a else quoted(c) for c in df.columns])
    raise ValueError(f"target {target!r} not found, nor any of {list(aliases)}; available: {df.columns}")


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: null count and percentage, from a single aggregation."""
    return _unpivot_counts(df)


def _missing(df: DataFrame, name: str) -> Column:
    c = quoted(name)
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _unpivot_counts(df: DataFrame) -> DataFrame:
    counted = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(_missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)],
    )
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_null")) for i, c in enumerate(df.columns)
    ]
    return counted.select("n_rows", F.inline(F.array(*entries))).select(
        "column",
        "n_rows",
        "n_null",
        F.try_divide(F.col("n_null") * 100.0, F.col("n_rows")).alias("pct_null"),
    )


def sparse_columns(df: DataFrame, max_missing_percentage: float = 50) -> list[str]:
    """Columns with strictly more missing than allowed; none for an empty table."""
    row = df.agg(
        F.count("*").alias("n"), *[F.count_if(_missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)]
    ).first()
    if row["n"] == 0:
        return []
    return [c for i, c in enumerate(df.columns) if row[f"m{i}"] / row["n"] * 100 > max_missing_percentage]


def drop_sparse(df: DataFrame, max_missing_percentage: float = 50) -> DataFrame:
    return drop_columns(df, sparse_columns(df, max_missing_percentage))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One row per distinct full row; nulls (and NaN) are equal to each other."""
    return _deduplicated(normalise_missing(df))[0]


def _row_hash(rows: DataFrame, seed: int = 0) -> Column:
    floats = {f.name for f in rows.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    # Adding zero makes -0.0 and 0.0 one value, as they are when rows are compared.
    parts = [quoted(c) + F.lit(0.0) if c in floats else quoted(c) for c in rows.columns]
    return F.xxhash64(F.lit(seed), *parts)


def _deduplicated(rows: DataFrame) -> tuple[DataFrame, bool]:
    """The distinct rows, and whether there was any duplicate.

    Only an 8-byte hash of each row is shuffled, to find hashes that occur twice. Rows with another
    hash are unique; the others are compared in full. The hashes are kept in the shared folder, so
    that using the result does not find them again; Spark broadcasts them if they are few.
    """
    hashed = rows.withColumn("_row_hash", _row_hash(rows))
    again = hashed.groupBy("_row_hash").agg(F.count("*").alias("_n")).where("_n > 1").select("_row_hash")
    found = written(again, "hashes")
    if found.isEmpty():
        return rows, False
    single = hashed.join(found, "_row_hash", "left_anti").drop("_row_hash")
    compared = hashed.join(found, "_row_hash", "left_semi").drop("_row_hash").dropDuplicates()
    return single.unionByName(compared), True


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and the difference; rows are compared by 128 bits of hash, which is what is shuffled."""
    rows = normalise_missing(df)
    groups = rows.groupBy(_row_hash(rows).alias("_a"), _row_hash(rows, 1).alias("_b")).agg(F.count("*").alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_distinct"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"),
    )


def validate(df: DataFrame, cfg: ValidationConfig = ValidationConfig()) -> DataFrame:
    """Drop sparse columns, then duplicate rows."""
    return validated(df, cfg)[0]


def validated(df: DataFrame, cfg: ValidationConfig) -> tuple[DataFrame, bool]:
    """The validated rows, and whether duplicates were dropped (which costs a shuffle per pass)."""
    if not cfg.enabled:
        return df, False
    df = normalise_missing(df)
    if cfg.check_missing_values:
        df = drop_sparse(df, cfg.max_missing_percentage)
    return _deduplicated(df) if cfg.check_duplicates else (df, False)


def cast_columns(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return df.select(*[quoted(c).cast(kinds[c]).alias(c) if c in kinds else quoted(c) for c in df.columns])


def booleans_to_int(df: DataFrame) -> DataFrame:
    return cast_columns(df, {c: "int" for c in boolean_columns(df)})


def coerce_timestamps(df: DataFrame, names: Sequence[str], formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Parse the named text columns, ISO or in one of the formats; what cannot be parsed becomes null."""
    present = [c for c in names if c in df.columns]

    def parsed(c: str) -> Column:
        if c in date_columns(df):
            return quoted(c).cast("timestamp_ntz").alias(c)
        return timestamp_of(c, formats).alias(c)

    return df.select(*[parsed(c) if c in present else quoted(c) for c in df.columns])


def fill_constant(df: DataFrame, value: float = 0) -> DataFrame:
    """Null -> value in numeric and boolean columns."""
    out = []
    for f in df.schema.fields:
        c = quoted(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = nan_to_null(c)
        if isinstance(f.dataType, NUMERIC_TYPES):
            c = F.coalesce(c, F.lit(value).cast(f.dataType))
        elif isinstance(f.dataType, T.BooleanType):
            c = F.coalesce(c, F.lit(bool(value)))
        out.append(c.alias(f.name))
    return df.select(*out)


def fill_sentinel(df: DataFrame, names: Sequence[str], sentinel: str = "UNKNOWN") -> DataFrame:
    """Null -> sentinel text in the named columns, which become text."""
    gone = set(names)
    return df.select(
        *[F.coalesce(quoted(c).cast("string"), F.lit(sentinel)).alias(c) if c in gone else quoted(c) for c in df.columns]
    )


def impute_values(df: DataFrame, names: Sequence[str], strategy: str = "median") -> dict[str, object]:
    """The fill value per column. All columns share each pass; exact for every strategy."""
    names = [c for c in names if c in df.columns]
    if not names:
        return {}
    if strategy == "median":
        return {c: q[0] for c, q in exact_quantiles(df, {c: [0.5] for c in names}).items()}
    if strategy == "mean":
        row = normalise_missing(df.select(*[quoted(c) for c in names])).agg(
            *[F.avg(quoted(c).cast("double")) for c in names]
        )
        return dict(zip(names, row.first()))
    if strategy == "most_frequent":
        return _most_frequent(df, names)
    raise ValueError(f"unknown strategy {strategy!r}; use mean, median or most_frequent")


def _most_frequent(df: DataFrame, names: Sequence[str]) -> dict[str, object]:
    """Most frequent value per column, the smallest on ties; the columns of a type share one grouped count."""
    from tabweave.operators.encode import cells

    out: dict[str, object] = {c: None for c in names}
    for part in cells(df, names):
        counts = part.groupBy("name", "value").agg(F.count("*").alias("n"))
        best = counts.groupBy("name").agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("best"))
        out |= {r["name"]: r["best"]["value"] for r in best.collect()}
    return out


def fill_values(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Null -> literal per column. A whole-number column stays whole if its fill value is."""
    out = []
    for f in df.schema.fields:
        c, v = quoted(f.name), values.get(f.name)
        if v is None:
            out.append(c)
            continue
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = nan_to_null(c)
        if isinstance(v, float) and not v.is_integer():
            c = c.cast("double")
            out.append(F.coalesce(c, F.lit(v)).alias(f.name))
        else:
            out.append(F.coalesce(c, F.lit(v).cast(f.dataType)).alias(f.name))
    return df.select(*out)


def impute(df: DataFrame, names: Sequence[str], strategy: str = "median") -> DataFrame:
    return fill_values(df, impute_values(df, names, strategy))


def first_rows(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*[quoted(k) for k in keys]).limit(n)


def only_class(df: DataFrame, label: str, value) -> DataFrame:
    return df.where(quoted(label) == F.lit(value))


# ------------------------------------------------------------------ summaries


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, nulls left out. Order by count descending for a report."""
    kept = df.where(quoted(column).isNotNull())
    return kept.groupBy(quoted(column).alias(column)).agg(F.count("*").alias("n"))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per integer class, for 0 .. max(class), also those without rows."""
    y = quoted(label).cast("int")
    counted = df.where(y.isNotNull()).groupBy(y.alias("class")).agg(F.count("*").alias("n"))
    last = counted.agg(F.max("class")).first()[0]
    span = df.sparkSession.range(0 if last is None else last + 1).select(F.col("id").cast("int").alias("class"))
    return span.join(counted, "class", "left").select("class", F.coalesce("n", F.lit(0)).alias("n"))


def describe(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max; one row per column."""
    names = list(names)
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in names})
    clean = normalise_missing(df.select(*[quoted(c) for c in names]))
    aggs, entries = [], []
    for i, c in enumerate(names):
        v = quoted(c).cast("double")
        aggs += [
            F.count(v).alias(f"n{i}"),
            F.avg(v).alias(f"a{i}"),
            F.stddev_samp(v).alias(f"s{i}"),
            F.min(v).alias(f"l{i}"),
            F.max(v).alias(f"h{i}"),
        ]
        q = [F.lit(x).cast("double") for x in quartiles[c]]
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"n{i}").alias("count"),
                F.col(f"a{i}").alias("mean"),
                F.col(f"s{i}").alias("std"),
                F.col(f"l{i}").alias("min"),
                q[0].alias("q25"),
                q[1].alias("median"),
                q[2].alias("q75"),
                F.col(f"h{i}").alias("max"),
            )
        )
    return clean.agg(*aggs).select(F.inline(F.array(*entries)))


def data_summary(df: DataFrame, label: str) -> DataFrame:
    """One record: shape, features and target; of a text target the rows of each value too, a JSON object in order of value.

    A number has no such object (null), as it may have a value for each row; ``value_counts`` gives those as a table.
    """
    features, _ = features_and_label(df, label)
    told = None
    if isinstance(df.schema[label].dataType, T.StringType):
        # One entry per class.
        counts = {str(r[label]): r["n"] for r in value_counts(df, label).collect()}
        told = json.dumps(counts, sort_keys=True, separators=(",", ":"))
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(quoted(label).isNotNull()).alias("n_labelled"),
    ).select(
        "n_rows",
        "n_labelled",
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.lit(len(features)).cast("bigint").alias("feature_count"),
        F.array_join(F.array(*[F.lit(c) for c in features]), ",").alias("feature_names"),
        F.lit(label).alias("target_column"),
        F.lit(told).cast("string").alias("target_distribution"),
    )
