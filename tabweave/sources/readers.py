"""Readers for delimited text, Parquet and JSON request batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.functions.columns import quoted

# Texts that count as missing in delimited files. The text "None" is not
# among them, because it is a legal label. Pass another list to change that.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)

FORMATS = {".csv": "csv", ".tsv": "tsv", ".parquet": "parquet"}


def format_of(path: str) -> str:
    for suffix, fmt in FORMATS.items():
        if path.rstrip("/").lower().endswith(suffix):
            return fmt
    raise ValueError(f"unsupported file format: {path}; known: {', '.join(FORMATS)}")


def read_table(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    fmt = fmt or format_of(path)
    if fmt == "parquet":
        return read_parquet(spark, path, **options)
    if fmt in ("csv", "tsv"):
        return read_delimited(spark, path, sep="\t" if fmt == "tsv" else ",", **options)
    raise ValueError(f"unsupported format: {fmt}")


def read_parquet(spark: SparkSession, path: str | Sequence[str], path_column: str | None = None) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    return df if path_column is None else df.select("*", F.col("_metadata.file_path").alias(path_column))


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    sep: str = ",",
    encoding: str = "UTF-8",
    null_tokens: Sequence[str] = NULL_TOKENS,
    line_breaks_in_quotes: bool = False,
    path_glob: str | None = None,
) -> DataFrame:
    """Delimited text; every file has a header line.

    With a schema the read is lazy; a value that does not fit is an error. Without one, one
    extra pass finds the types: whole number, float, boolean or text. Spark splits large files;
    ``line_breaks_in_quotes`` reads fields with line breaks, and then a file in one task.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("encoding", _charset(encoding))
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", line_breaks_in_quotes)
        .option("mode", "FAILFAST")
        .option("maxCharsPerColumn", -1)
        # Nothing between two separators is null, a quoted empty text is text.
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
    )
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    raw = reader.csv(paths, inferSchema=False)
    tokens = list(null_tokens)
    texts = raw.select(
        *[F.when(~quoted(c).isin(tokens), quoted(c)).alias(c) if tokens else quoted(c) for c in raw.columns]
    )
    if schema is None:
        return _typed(texts, _inferred(texts))
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    missing = [f.name for f in wanted.fields if f.name not in texts.columns]
    if missing:
        raise ValueError(f"columns {missing} not in the header; found: {texts.columns}")
    return _typed(texts, {f.name: f.dataType.simpleString() for f in wanted.fields})


def _charset(encoding: str) -> str:
    return {"ascii": "US-ASCII", "utf8": "UTF-8"}.get(encoding.lower(), encoding)


def _inferred(texts: DataFrame) -> dict[str, str]:
    """One aggregation over all columns: does every present value parse as the type?"""
    aggs = []
    for i, c in enumerate(texts.columns):
        v = quoted(c)
        aggs += [
            F.count("*").alias(f"r{i}"),
            F.count(v).alias(f"n{i}"),
            F.count_if(v.rlike(r"^\s*[+-]?\d+\s*$") & v.try_cast("bigint").isNotNull()).alias(f"w{i}"),
            F.count_if(v.try_cast("double").isNotNull()).alias(f"f{i}"),
            F.count_if(v.isin("True", "TRUE", "true", "False", "FALSE", "false")).alias(f"b{i}"),
        ]
    row = texts.agg(*aggs).first()
    kinds = {}
    for i, c in enumerate(texts.columns):
        n, full = row[f"n{i}"], row[f"r{i}"] == row[f"n{i}"]
        if n == row[f"w{i}"] and full and n:
            kinds[c] = "bigint"
        elif n == row[f"f{i}"]:
            kinds[c] = "double"
        elif n == row[f"b{i}"]:
            kinds[c] = "boolean"
        else:
            kinds[c] = "string"
    return kinds


def _typed(texts: DataFrame, kinds: dict[str, str]) -> DataFrame:
    return texts.select(*[quoted(c).cast(k).alias(c) for c, k in kinds.items()])


def read_folder(spark: SparkSession, folder: str, glob: str = "*.csv", **options) -> DataFrame:
    """All matching files of a folder as one table."""
    if not _file_listing(spark, folder, glob).head(1):
        raise FileNotFoundError(f"no {glob} in {folder}")
    return read_delimited(spark, folder, path_glob=glob, **options)


def _file_listing(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    # Only path and time are selected, so no file content is read.
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select("path", "modificationTime")


def latest_file(spark: SparkSession, folder: str, glob: str = "*.csv") -> str:
    """Path of the newest matching file (the larger name on equal times)."""
    newest = F.max(F.struct("modificationTime", "path"))
    row = _file_listing(spark, folder, glob).agg(newest.alias("m")).first()
    if row["m"] is None:
        raise FileNotFoundError(f"no {glob} in {folder}")
    return row["m"]["path"]


def read_latest(spark: SparkSession, folder: str, glob: str = "*.csv", **options) -> DataFrame:
    return read_delimited(spark, latest_file(spark, folder, glob), **options)


def peek_schema(spark: SparkSession, path: str, label: str | None = None) -> list[str]:
    """Feature names of a table without reading its rows."""
    fmt = format_of(path)
    if fmt == "parquet":
        names = spark.read.parquet(path).columns
    else:
        names = spark.read.option("header", True).option("sep", "\t" if fmt == "tsv" else ",").csv(path).columns
    return [c for c in names if c != label]


def parse_requests(df: DataFrame, body: str, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """JSON records in a text column -> typed columns plus ``error`` (null when it parsed).

    A body that is no JSON object, or has a value of a wrong type, gives an error row; no row is lost.
    """
    fields = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_json(quoted(body), fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    message = F.concat(F.lit("cannot parse: "), F.coalesce(F.col("_r._bad"), F.lit("null")))
    failed = F.col("_r").isNull() | F.col("_r._bad").isNotNull()
    return df.withColumn("_r", parsed).select(
        *[quoted(k) for k in keep],
        *[F.when(~failed, F.col("_r")[f.name]).alias(f.name) for f in schema.fields],
        F.when(failed, message).alias("error"),
    )


def parse_split_requests(df: DataFrame, body: str, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """``{"input_data": {"columns": [...], "data": [[...], ...]}}`` -> one row per inner record.

    Values are matched by the names the request gives; a missing name is null.
    """
    kind = "struct<input_data:struct<columns:array<string>,data:array<array<string>>>,_bad:string>"
    parsed = F.from_json(quoted(body), kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    base = df.withColumn("_r", parsed)
    good = F.col("_r.input_data.data").isNotNull() & F.col("_r.input_data.columns").isNotNull()
    opened = base.select(
        *[quoted(k) for k in keep],
        F.when(~good, F.concat(F.lit("cannot parse: "), F.coalesce(quoted(body), F.lit("null")))).alias("error"),
        F.col("_r.input_data.columns").alias("_names"),
        F.posexplode_outer(F.when(good, F.col("_r.input_data.data"))).alias("row", "_values"),
    )

    def pick(f: T.StructField):
        at = F.array_position("_names", f.name)
        return F.when(at > 0, F.try_element_at("_values", at.cast("int"))).try_cast(f.dataType).alias(f.name)

    return opened.select(*[quoted(k) for k in keep], "row", *[pick(f) for f in schema.fields], "error")


# Names of the first columns of a synthetic table, in order.
SYNTHETIC_NAMES = (
    "age", "bmi", "blood_pressure", "cholesterol", "glucose", "heart_rate", "smoking_status",
    "exercise_freq", "family_history", "medication_count", "sleep_hours", "stress_level",
    "diet_score", "alcohol_consumption", "previous_conditions",
)


def synthetic(spark: SparkSession, n: int = 1000, k: int = 10, task: str = "classification", seed: int = 42) -> DataFrame:
    """Labelled random rows: up to 8 informative features, then up to 2 sums of them, then noise.

    A class label is the sign of a noisy linear score; a regression label adds noise of scale 10.
    """
    names = [SYNTHETIC_NAMES[i] if i < len(SYNTHETIC_NAMES) else f"feature_{i}" for i in range(k)]
    informative = min(8, k)
    redundant = min(2, k - 8) if k > 8 and task == "classification" else 0
    df = spark.range(n).select(
        F.col("id").alias("row_id"),
        *[F.randn(seed + i).alias(names[i]) for i in range(k) if not informative <= i < informative + redundant],
        F.randn(seed + k).alias("_noise"),
    )
    for j in range(redundant):
        df = df.withColumn(names[informative + j], quoted(names[j]) + quoted(names[j + 1]))
    weights = [(-1.0) ** i * (1.0 + i / 2) for i in range(informative)]
    score = sum((F.lit(w) * quoted(c) for w, c in zip(weights, names)), F.lit(0.0))
    if task == "classification":
        label = (score + F.col("_noise") > 0).cast("int")
    elif task == "regression":
        label = F.lit(10.0) * score + F.lit(10.0) * F.col("_noise")
    else:
        raise ValueError(f"unknown task {task!r}")
    return df.select("row_id", *[quoted(c) for c in names], label.alias("target"))
