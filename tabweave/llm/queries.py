"""The queries of this package, by name, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.llm import decontaminate, filter_audit, html_text, jaccard_join, line_spread, mixing, pieces, quality_rules, ranked_search, substring_dedup, suffix_dedup, surrogates, token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {"op3_line_spread": line_spread.SQL, "op4_source_mix": mixing.SQL, "op11_ranked_search": ranked_search.SQL, "op12_filter_audit": filter_audit.SQL}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


@query
def op1_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract(read(spark, sf, "pages"))


@query
def op4_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.take(read(spark, sf, "documents"))


@query
def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    scored = quality_rules.score(read(spark, sf, "documents"))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_words", "longest_repeat"
    )


@query
def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")))


@query
def op7_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = substring_dedup.dedup(read(spark, sf, "documents"))
    return found.select(found["id"].alias("doc_id"), "n_words", "n_removed", "kept_sha256")


@query
def op10_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = suffix_dedup.dedup(read(spark, sf, "documents"), with_kept=False)
    return found.select(found["id"].alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op2_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    found = jaccard_join.near_copies(read(spark, sf, "documents"))
    return found.select(found["id"].alias("doc_id"), "n_shingles", "component_id")


@query
def op3_line_spread(spark: SparkSession, sf: str) -> DataFrame:
    return line_spread.dedup(read(spark, sf, "documents")).select("doc_id", "n_lines", "n_removed", "text")


@query
def op8_benchmark_leaks(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.leaks(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
    return found.select(found["doc"].alias("doc_id"), found["item"].alias("item_id"), "edits")


@query
def op9_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    return surrogates.replace_entities(read(spark, sf, "documents")).select("doc_id", "text", "n_entities")


@query
def op13_piece_ids(spark: SparkSession, sf: str) -> DataFrame:
    model = str(public_tokenizers.path("piece_bpe_32k.model"))
    found = pieces.encode(read(spark, sf, "documents"), model, decoded="decoded")
    digest = F.sha2(F.array_join("ids", ","), 256)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.interactions(read(spark, sf, "documents"), read(spark, sf, "labels"))


@query
def op11_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    counted = ranked_search.totals(docs)
    index = ranked_search.write_index(ranked_search.build(docs, counted=counted))
    return ranked_search.search(index, read(spark, sf, "benchmark"), counted[0]).select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")
