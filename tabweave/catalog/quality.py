"""Queries over cleaning and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabweave.catalog.base import (
    GAPPY_SQL,
    LABELLED_SQL,
    big,
    gappy_events,
    labelled_documents,
    longs,
    query,
    rounded,
    scored_lines,
    table,
)
from tabweave.config import ValidationConfig
from tabweave.operators import quality as Q
from tabweave.operators.scoring import align

_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS n_null,
        round(count(*) FILTER ({c} IS NULL) * 100.0 / count(*), 6)::double AS pct_null FROM labelled"""
    for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
)


@query(f"WITH {LABELLED_SQL} {_PROFILE}")
def null_profile(spark, sf):
    return rounded(Q.null_profile(labelled_documents(spark, sf)), "pct_null")


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def drop_sparse(spark, sf):
    return Q.drop_sparse(labelled_documents(spark, sf), 50)


@query("SELECT DISTINCT * REPLACE (l_linenumber::bigint AS l_linenumber) FROM lineitem")
def dedup(spark, sf):
    """Whole rows, every second order given twice."""
    rows = table(spark, sf, "lineitem")
    return longs(Q.drop_duplicate_rows(rows.unionByName(rows.where("l_orderkey % 2 = 0"))), "l_linenumber")


@query("SELECT DISTINCT text, lang, source, n_chars FROM documents")
def dedup_wide_rows(spark, sf):
    """Whole texts: only their hashes are shuffled, unless two rows share one."""
    return Q.drop_duplicate_rows(table(spark, sf, "documents").drop("doc_id"))


@query(f"WITH {LABELLED_SQL} SELECT DISTINCT text, lang, source, quality::double AS quality, toxic::double AS toxic FROM labelled")
def dedup_with_nulls(spark, sf):
    rows = labelled_documents(spark, sf).drop("doc_id", "n_chars")
    return Q.drop_duplicate_rows(Q.cast_columns(rows, {"quality": "double", "toxic": "double"}))


@query(
    """SELECT sum(n)::bigint AS n_rows, count(*) AS n_distinct, sum(n - 1)::bigint AS n_duplicates FROM (SELECT *, count(*) AS n
       FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 2 = 0) GROUP BY ALL)"""
)
def duplicate_count(spark, sf):
    """Whole rows, every second order given twice."""
    rows = table(spark, sf, "lineitem")
    return Q.duplicate_count(rows.unionByName(rows.where("l_orderkey % 2 = 0")))


@query(f"WITH {LABELLED_SQL} SELECT DISTINCT text, lang, source, n_chars FROM labelled")
def validate_table(spark, sf):
    rows = labelled_documents(spark, sf).drop("doc_id")
    return Q.validate(rows, ValidationConfig(max_missing_percentage=50))


@query(
    f"""WITH {GAPPY_SQL} SELECT event_id, user_id,
        round(coalesce(value, (SELECT quantile_cont(value, 0.5) FROM gappy)), 6) AS value, event_type FROM gappy"""
)
def median_impute(spark, sf):
    return rounded(Q.impute(gappy_events(spark, sf), ["value"], "median"), "value")


@query(
    f"""WITH {GAPPY_SQL} SELECT event_id, user_id,
        round(coalesce(value, (SELECT avg(value) FROM gappy)), 6) AS value, event_type FROM gappy"""
)
def mean_impute(spark, sf):
    return rounded(Q.impute(gappy_events(spark, sf), ["value"], "mean"), "value")


@query(
    f"""WITH {GAPPY_SQL}, top AS (SELECT event_type AS t FROM gappy WHERE event_type IS NOT NULL
          GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
        SELECT event_id, user_id, value, coalesce(event_type, (SELECT t FROM top)) AS event_type FROM gappy"""
)
def mode_impute(spark, sf):
    return Q.impute(gappy_events(spark, sf), ["event_type"], "most_frequent")


@query(f"WITH {GAPPY_SQL} SELECT event_id, user_id, value, coalesce(event_type, 'UNKNOWN') AS event_type FROM gappy")
def sentinel_fill(spark, sf):
    return Q.fill_sentinel(gappy_events(spark, sf), ["event_type"], "UNKNOWN")


@query(
    f"""WITH {LABELLED_SQL} SELECT doc_id, text, lang, source, n_chars, coalesce(quality, 0)::bigint AS quality,
        coalesce(toxic, 0)::bigint AS toxic FROM labelled"""
)
def zero_fill(spark, sf):
    return longs(Q.fill_constant(labelled_documents(spark, sf), 0), "quality", "toxic")


@query("SELECT doc_id, quality::bigint AS \"MACE\", toxic::bigint AS toxic FROM labels")
def target_rename(spark, sf):
    rows = table(spark, sf, "labels").withColumnRenamed("quality", "CVD_RISK")
    return longs(Q.rename_target(rows, "MACE"), "MACE", "toxic")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS o_orderdate FROM orders"""
)
def coerce_dates(spark, sf):
    """ISO texts, American dates and texts that are no date."""
    day = F.date_format("o_orderdate", "MM/dd/yyyy")
    text = F.when(F.col("o_orderstatus") == "P", F.lit("not a date")).when(F.col("o_orderstatus") == "F", day)
    text = text.otherwise(F.col("o_orderdate").cast("string"))
    rows = table(spark, sf, "orders").select("o_orderkey", text.alias("o_orderdate"))
    return Q.coerce_timestamps(rows, ["o_orderdate", "absent"])


@query(
    """SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, (l_returnflag = 'R')::bigint AS returned,
       l_quantity::float::double AS l_quantity FROM lineitem"""
)
def cast_types(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_returnflag") == "R").alias("returned"), "l_quantity"
    )
    cast = Q.cast_columns(Q.booleans_to_int(rows), {"l_quantity": "float", "l_linenumber": "bigint"})
    return cast.withColumn("l_quantity", F.col("l_quantity").cast("double")).withColumn("returned", big("returned"))


@query("SELECT doc_id, source, n_chars FROM documents")
def drop_listed(spark, sf):
    return Q.drop_columns(table(spark, sf, "documents"), ["text", "lang", "TEXT", "absent"])


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def label_distribution(spark, sf):
    return Q.value_counts(table(spark, sf, "orders"), "o_orderpriority")


@query("SELECT quality::bigint AS class, count(*) AS n FROM labels GROUP BY 1")
def class_counts(spark, sf):
    return longs(Q.class_counts(table(spark, sf, "labels"), "quality"), "class", "n")


_DESCRIBE = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
        round(min({c}), 6) AS "min", round(quantile_cont({c}, 0.25), 6) AS q25, round(median({c}), 6) AS median,
        round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS "max" FROM lineitem"""
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
)


@query(_DESCRIBE)
def describe_numbers(spark, sf):
    out = Q.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return rounded(out, "mean", "std", "min", "q25", "median", "q75", "max")


@query("SELECT count(*) AS n_rows, 11::bigint AS n_columns FROM lineitem")
def table_shape(spark, sf):
    return Q.shape(table(spark, sf, "lineitem"))


@query(
    f"""WITH {LABELLED_SQL} SELECT count(*) AS n_rows, count(quality) AS n_labelled, 7::bigint AS n_columns,
        6::bigint AS feature_count, 'doc_id,text,lang,source,n_chars,toxic' AS feature_names, 'quality' AS target_column,
        (SELECT '{{' || string_agg('"' || quality || '":' || n, ',' ORDER BY quality) || '}}' FROM
          (SELECT quality, count(*) AS n FROM labelled WHERE quality IS NOT NULL GROUP BY 1)) AS target_distribution FROM labelled"""
)
def data_summary(spark, sf):
    docs = labelled_documents(spark, sf)
    return Q.data_summary(docs.withColumn("quality", F.col("quality").cast("string")), "quality")


@query("SELECT count(*) AS n_rows, count(l_extendedprice) AS n_labelled, 'l_extendedprice' AS target_column, true AS no_distribution FROM lineitem")
def data_summary_number(spark, sf):
    """A price as the target: its values are not told one by one."""
    out = Q.data_summary(table(spark, sf, "lineitem"), "l_extendedprice")
    return out.select("n_rows", "n_labelled", "target_column", F.col("target_distribution").isNull().alias("no_distribution"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def head_rows(spark, sf):
    return Q.first_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 5)


@query(
    """SELECT l_returnflag = 'R' AS positive, count(*) AS n, round(sum(l_quantity), 6) AS quantity
       FROM lineitem GROUP BY 1"""
)
def class_filter(spark, sf):
    rows = scored_lines(spark, sf)
    parts = [
        Q.only_class(rows, "label", c)
        .groupBy(F.lit(bool(c)).alias("positive"))
        .agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 6).alias("quantity"))
        for c in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


@query(
    """SELECT o_orderkey, NULL::double AS bmi, o_orderdate, o_totalprice::bigint AS o_totalprice FROM
       (SELECT o_orderkey, o_orderdate, floor(o_totalprice) AS o_totalprice FROM orders)"""
)
def align_contract(spark, sf):
    rows = table(spark, sf, "orders").withColumn("o_totalprice", F.floor("o_totalprice"))
    contract = "o_orderkey bigint, bmi double, o_orderdate timestamp_ntz, o_totalprice bigint"
    from pyspark.sql.types import StructType

    return align(rows, StructType.fromDDL(contract))
