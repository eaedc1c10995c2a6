"""Writers. Every write goes to a new folder or a new partition; nothing is collected."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.sources.readers import read_delimited


def run_stamp(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")


def write_prepared(df: DataFrame, folder: str, fmt: str = "parquet", stamp: str | None = None) -> str:
    """Write the prepared table below a folder stamped with the run time; return its path."""
    path = f"{folder.rstrip('/')}/preprocessed_{stamp or run_stamp()}"
    if fmt == "parquet":
        df.write.parquet(path)
    elif fmt == "csv":
        write_delimited(df, path)
    else:
        raise ValueError(f"unsupported format: {fmt}")
    return path


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    """Delimited text with a header in each file. Quotes inside values are doubled.

    Empty text is written quoted, null as nothing.
    """
    (
        df.write.option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", '""')
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
        .csv(path)
    )


def csv_to_parquet(spark, source: str, target: str, **options) -> None:
    read_delimited(spark, source, **options).write.parquet(target)


def write_splits(df: DataFrame, path: str, split_column: str = "split") -> None:
    """Features and label of all parts in one table, one folder per part."""
    df.write.partitionBy(split_column).parquet(path)


def log_metrics(metrics: DataFrame, path: str, run_id: str) -> None:
    """Append (run_id, metric, value, ts) rows from a (metric, value) table."""
    metrics.select(
        F.lit(run_id).alias("run_id"),
        F.col("metric").cast("string").alias("metric"),
        F.col("value").cast("double").alias("value"),
        F.current_timestamp().alias("ts"),
    ).write.mode("append").parquet(path)


def tall(row: DataFrame) -> DataFrame:
    """A one-row table of numbers as (metric, value) rows."""
    entries = [F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").cast("double").alias("value")) for c in row.columns]
    return row.select(F.inline(F.array(*entries)))


def write_tables(tables: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """One Parquet folder per named table; returns the paths."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder.rstrip('/')}/{name}"
        df.write.parquet(paths[name])
    return paths
