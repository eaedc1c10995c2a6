"""A training corpus from the documents: rules, lines, near copies, benchmark passages, source weights.

Every stage reads all that the one before it kept. The first four return the columns of `documents`; the last returns what
the mix takes of each document that is left. SQL cannot express the suffix arrays of the first stage nor the alignments of
the fourth, so there is no SQL for the whole; the tests hold each stage against a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.llm import decontaminate, jaccard_join, line_spread, mixing, quality_rules
from tabweave.session import written


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, unchanged."""
    return quality_rules.keep_good(docs)


def boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that are spread over sites; those of which no word is left go. `n_chars` follows the text."""
    # Columns of the input that are called like the counters of line dedup keep their values.
    held = {c: f"_held_{c}" for c in docs.columns if c.lower() in ("n_lines", "n_removed")}
    cut = line_spread.dedup(docs.withColumnsRenamed(held), spread=line_spread.Spread(by_content=True))
    left = cut.where((F.col("n_removed") == 0) | (mixing.n_words(F.col("text")) > 0))
    chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return left.withColumn("n_chars", chars).select(*[left[held[c]].alias(c) if c in held else F.col(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id, unchanged."""
    return jaccard_join.keep_first(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage, unchanged."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document that is left."""
    return mixing.take(docs)


STAGES = [
    ("quality rules", rules),
    ("line dedup", boilerplate),
    ("near copies", near_copies),
    ("benchmark passages", benchmark_passages),
    ("source mix", source_mix),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
