"""Registry of the driver queries: a Spark function and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.functions.columns import linear_score, quoted

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(fn):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} exists twice")
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def r6(c: Column | str) -> Column:
    """Rounded to 6 places, without a negative zero."""
    c = quoted(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6) + F.lit(0.0)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    gone = set(names)
    return df.select(*[r6(c).alias(c) if c in gone else quoted(c) for c in df.columns])


def big(c: Column | str) -> Column:
    return (quoted(c) if isinstance(c, str) else c).cast("bigint")


def longs(df: DataFrame, *names: str) -> DataFrame:
    gone = set(names)
    return df.select(*[big(c).alias(c) if c in gone else quoted(c) for c in df.columns])


# The linear scorer that metrics and explanations are shown on.
WEIGHTS = {"l_quantity": 0.02, "l_extendedprice": 0.00001, "l_discount": 3.0, "l_tax": -2.0}
INTERCEPT = -1.0
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
MARGIN_SQL = "(-1.0 + 0.02*l_quantity + 0.00001*l_extendedprice + 3.0*l_discount + -2.0*l_tax)"


def scored_lines(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with label (returned), margin, probability and prediction of the scorer."""
    lines = table(spark, sf, "lineitem")
    out = lines.withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    out = out.withColumn("margin", linear_score(WEIGHTS, INTERCEPT))
    out = out.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin"))))
    return out.withColumn("prediction", (F.col("score") > 0.5).cast("int"))


SCORED_SQL = f"""scored AS (
  SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, {MARGIN_SQL} AS margin,
         1.0/(1.0+exp(-{MARGIN_SQL})) AS score, CASE WHEN 1.0/(1.0+exp(-{MARGIN_SQL})) > 0.5 THEN 1 ELSE 0 END AS prediction
  FROM lineitem)"""


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    """documents with their labels; unlabelled documents have null quality and toxic."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left")


LABELLED_SQL = """labelled AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def gappy_events(spark: SparkSession, sf: str) -> DataFrame:
    """events where an error carries no value and a signup no user segment."""
    e = table(spark, sf, "events")
    return e.select(
        "event_id",
        "user_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.when(F.col("event_type") != "signup", F.col("event_type")).alias("event_type"),
    )


GAPPY_SQL = """gappy AS (
  SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN value END AS value,
         CASE WHEN event_type <> 'signup' THEN event_type END AS event_type
  FROM events)"""


def hash_sql(*keys: str) -> str:
    text = " || '|' || ".join(["'42'", *[f"{k}::varchar" for k in keys]])
    return f"('0x' || substr(md5({text}), 1, 15))::bigint"
