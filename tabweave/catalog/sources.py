"""Queries over readers and writers: each writes a table to the shared folder and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabweave.catalog.base import LABELLED_SQL, SCORED_SQL, labelled_documents, longs, query, rounded, scored_lines, table
from tabweave.operators.metrics import accuracy
from tabweave.operators.split import split_by_bucket
from tabweave.catalog.base import hash_sql
from tabweave.session import fresh_dir
from tabweave.sources import readers as R
from tabweave.sources import versions as V
from tabweave.sources import writers as W


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_roundtrip(spark, sf):
    """Whole texts with quotes and line breaks through CSV, read with a schema."""
    path = fresh_dir(spark, "csv")
    docs = table(spark, sf, "documents")
    W.write_delimited(docs, path)
    return R.read_delimited(spark, path, schema=docs.schema, null_tokens=(), line_breaks_in_quotes=True)


@query(f"WITH {LABELLED_SQL} SELECT doc_id, text, lang, source, n_chars, quality::double AS quality, toxic::double AS toxic FROM labelled")
def csv_inferred(spark, sf):
    """Types found in one pass; a whole-number column with gaps becomes float."""
    path = fresh_dir(spark, "csv") + ".csv"
    W.write_delimited(labelled_documents(spark, sf), path)
    return R.read_table(spark, path, line_breaks_in_quotes=True)


@query("SELECT c_custkey, c_name, c_nationkey::bigint AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def tsv_descriptor(spark, sf):
    """Two tab-separated folders in ascii, each file with its own header, read as one table."""
    base = fresh_dir(spark, "tsv")
    rows = table(spark, sf, "customer")
    W.write_delimited(rows.where("c_acctbal >= 0"), f"{base}/a", sep="\t")
    W.write_delimited(rows.where("c_acctbal < 0"), f"{base}/b", sep="\t")
    out = R.read_delimited(
        spark, [f"{base}/a", f"{base}/b"], schema=rows.schema, sep="\t", encoding="ascii", line_breaks_in_quotes=False
    )
    return longs(out, "c_nationkey")


@query("SELECT c_custkey, c_acctbal, true AS has_path FROM customer")
def parquet_with_path(spark, sf):
    out = R.read_parquet(spark, f"{sf.rstrip('/')}/customer.parquet", path_column="path")
    return out.select("c_custkey", "c_acctbal", F.col("path").endswith("customer.parquet").alias("has_path"))


@query("SELECT p_partkey, p_name, p_retailprice FROM part")
def csv_to_parquet(spark, sf):
    base = fresh_dir(spark, "convert")
    rows = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    W.write_delimited(rows, f"{base}/csv")
    W.csv_to_parquet(spark, f"{base}/csv", f"{base}/parquet", encoding="ascii", schema=rows.schema)
    return R.read_parquet(spark, f"{base}/parquet")


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def folder_read(spark, sf):
    path = fresh_dir(spark, "folder")
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    W.write_delimited(rows, path)
    return R.read_folder(spark, path, schema=rows.schema)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def latest_file(spark, sf):
    """The newer of two files in one folder."""
    path = fresh_dir(spark, "latest")
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal").coalesce(1)
    old = rows.withColumn("s_acctbal", F.lit(0.0))
    old.write.option("header", True).csv(path)
    rows.write.mode("append").option("header", True).csv(path)
    return R.read_latest(spark, path, schema=rows.schema)


@query("SELECT c_custkey, upper(c_name) AS c_name, 2::bigint AS version FROM customer")
def versioned_read(spark, sf):
    """Two registered versions; ``latest`` is the second."""
    root = fresh_dir(spark, "registry")
    rows = table(spark, sf, "customer").select("c_custkey", "c_name")
    V.register(rows, root, "customer")
    version = V.register(rows.withColumn("c_name", F.upper("c_name")), root, "customer")
    out = V.read_registered(spark, {"dataset_root": root, "dataset_name": "customer", "dataset_version": "latest"})
    return longs(out.withColumn("version", F.lit(version)), "version")


@query(
    f"""SELECT o_orderkey, o_totalprice, CASE WHEN {hash_sql("o_orderkey")} % 100 < 20 THEN 'test' ELSE 'train' END AS split FROM orders"""
)
def written_splits(spark, sf):
    path = fresh_dir(spark, "splits")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    W.write_splits(split_by_bucket(rows, ["o_orderkey"], 20), path)
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", F.col("split").cast("string").alias("split"))


@query(
    f"""WITH {SCORED_SQL} SELECT 'run-1' AS run_id, 'accuracy' AS metric, round(avg((label = prediction)::int), 6) AS value FROM scored
        UNION ALL SELECT 'run-1', 'n', count(*)::double FROM scored"""
)
def metric_log(spark, sf):
    path = fresh_dir(spark, "metrics")
    W.log_metrics(W.tall(accuracy(scored_lines(spark, sf), "label", "prediction")), path, "run-1")
    return rounded(spark.read.parquet(path).drop("ts"), "value")


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def prepared_sink(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    path = W.write_prepared(rows, fresh_dir(spark, "prepared"), "csv")
    return R.read_delimited(spark, path, schema=rows.schema)
