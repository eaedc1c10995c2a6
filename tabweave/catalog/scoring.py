"""Queries over scoring: probability shapes, risk levels, JSON requests, Python models, a stream."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.catalog.base import INTERCEPT, LINE_KEY, SCORED_SQL, WEIGHTS, big, longs, query, r6, rounded, scored_lines, table
from tabweave.functions.columns import linear_score, risk_level
from tabweave.operators import scoring as P
from tabweave.session import fresh_dir
from tabweave.sources.readers import parse_requests, parse_split_requests
from tabweave.streaming.scoring import first_requests, request_stream, run_available, score_requests

_KEYS = "l_orderkey, l_linenumber::bigint AS l_linenumber, l_partkey, l_suppkey"


def _keyed(df, *more):
    return longs(df.select(*LINE_KEY, *more), "l_linenumber")


@query(
    f"""WITH {SCORED_SQL} SELECT {_KEYS}, round(score, 6) AS score,
        CASE WHEN score > 0.5 THEN 'HIGH RISK' ELSE 'LOW RISK' END AS risk_level FROM scored"""
)
def predict_threshold(spark, sf):
    rows = scored_lines(spark, sf)
    return _keyed(rows, r6("score").alias("score"), risk_level(F.col("score")).alias("risk_level"))


@query(f"WITH {SCORED_SQL} SELECT {_KEYS}, (1 - prediction)::double AS p0, prediction::double AS p1 FROM scored")
def label_proba(spark, sf):
    p0, p1 = P.label_as_proba(F.col("prediction"))
    return _keyed(scored_lines(spark, sf), p0.alias("p0"), p1.alias("p1"))


@query(
    f"""WITH {SCORED_SQL} SELECT {_KEYS}, (CASE WHEN prediction = 0 THEN 0.95 ELSE 0.05 END)::double AS p0,
        (CASE WHEN prediction = 1 THEN 0.95 ELSE 0.05 END)::double AS p1 FROM scored"""
)
def pseudo_proba(spark, sf):
    p0, p1 = P.pseudo_proba(F.col("prediction"))
    return _keyed(scored_lines(spark, sf), p0.alias("p0"), p1.alias("p1"))


@query(
    f"""WITH {SCORED_SQL} SELECT {_KEYS}, round(1 - score, 6) AS one_p0, round(score, 6) AS one_p1,
        round(l_discount / nullif(l_discount + l_tax, 0), 6) AS two_p0, round(l_tax / nullif(l_discount + l_tax, 0), 6) AS two_p1 FROM scored"""
)
def proba_repair(spark, sf):
    one = P.repair_proba([F.col("score")])
    two = P.repair_proba([F.col("l_discount"), F.col("l_tax")])
    cols = [r6(c).alias(n) for c, n in zip([*one, *two], ("one_p0", "one_p1", "two_p0", "two_p1"))]
    return _keyed(scored_lines(spark, sf), *cols)


@query(
    f"""WITH {SCORED_SQL} SELECT {_KEYS}, prediction::bigint AS from_number, prediction::bigint AS from_text, prediction::bigint AS from_flag FROM scored"""
)
def label_normalise(spark, sf):
    p = F.col("prediction")
    texts = F.when(p == 1, F.lit("True")).otherwise(F.lit("False"))
    cols = [big(P.as_label(c)).alias(n) for c, n in ((p, "from_number"), (texts, "from_text"), (p == 1, "from_flag"))]
    return _keyed(scored_lines(spark, sf), *cols)


@query(
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE (props ->> '$.k')::double END AS k, event_type = 'error' AS failed FROM events"""
)
def parse_json_requests(spark, sf):
    """The JSON bodies of events; an error event sends a cut-off body."""
    body = F.when(F.col("event_type") == "error", F.expr("substring(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    rows = table(spark, sf, "events").select("event_id", body.alias("body"))
    schema = T.StructType([T.StructField("k", T.DoubleType())])
    out = parse_requests(rows, "body", schema, ["event_id"])
    return out.select("event_id", "k", F.col("error").isNotNull().alias("failed"))


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, NULL::double AS bmi FROM orders")
def split_request_roundtrip(spark, sf):
    """Orders written as one-record split requests and parsed again; an unknown column is null."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_custkey")
    sent = P.split_rows(rows.withColumn("key", F.col("o_orderkey")), ["key"], "body")
    contract = T.StructType.fromDDL("o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string, bmi double")
    return parse_split_requests(sent, "body", contract, ["key"]).drop("key", "row", "error")


@query(
    """SELECT '{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
         CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END || '","event_type":' ||
         CASE WHEN event_type = 'signup' THEN 'null' ELSE '"' || event_type || '"' END || '}' AS json FROM events"""
)
def to_json_rows(spark, sf):
    kind = F.when(F.col("event_type") != "signup", F.col("event_type"))
    return P.json_rows(table(spark, sf, "events").select("event_id", "ts", kind.alias("event_type")))


@query(
    f"""WITH {SCORED_SQL}, c AS (SELECT max(score) FILTER (l_linestatus = 'O') AS low_score, max(score) FILTER (l_linestatus = 'F') AS high_score FROM scored)
        SELECT round(low_score, 6) AS low_score, round(high_score, 6) AS high_score, round(high_score - low_score, 6) + 0.0 AS difference,
          CASE WHEN high_score > low_score THEN 'higher risk identified' WHEN high_score = low_score THEN 'same risk'
               ELSE 'expected difference not shown' END AS verdict FROM c"""
)
def case_compare(spark, sf):
    out = P.compare_cases(scored_lines(spark, sf), "l_linestatus", "score", "O", "F")
    return rounded(out, "low_score", "high_score", "difference")


class _LinearModel:
    """A Python object with ``predict`` on a pandas frame, as users bring it."""

    def __init__(self, weights, intercept):
        self.weights, self.intercept = weights, intercept

    def predict(self, frame):
        return self.intercept + sum(w * frame[c] for c, w in self.weights.items())


@query(f"WITH {SCORED_SQL} SELECT {_KEYS}, round(margin, 9) + 0.0 AS prediction FROM scored")
def python_model(spark, sf):
    weights, intercept = dict(WEIGHTS), INTERCEPT
    out = P.score_with_python(
        table(spark, sf, "lineitem"), lambda: _LinearModel(weights, intercept), list(weights), LINE_KEY
    )
    return longs(out.withColumn("prediction", F.round("prediction", 9) + F.lit(0.0)), "l_linenumber")


@query(
    """SELECT event_id, (props ->> '$.k')::bigint AS k, NULL::double AS bmi, round(0.01 * (props ->> '$.k')::bigint, 6)::double AS score,
       CASE WHEN 0.01 * (props ->> '$.k')::bigint > 0.5 THEN 'HIGH RISK' ELSE 'LOW RISK' END AS risk_level FROM events"""
)
def stream_scoring(spark, sf):
    """JSON requests as a stream: parse, align to the contract, score, write, stop when done."""
    schema = table(spark, sf, "events").schema
    contract = T.StructType([T.StructField("k", T.LongType()), T.StructField("bmi", T.DoubleType())])

    def score(df):
        scored = df.withColumn("score", linear_score({"k": 0.01}))
        return scored.withColumn("risk_level", risk_level(F.col("score")))

    stream = request_stream(spark, sf, schema, glob="events.parquet")
    base = fresh_dir(spark, "stream")
    scored = score_requests(stream, "props", contract, score, ["event_id"])
    run_available(scored, f"{base}/out", f"{base}/checkpoint")
    return rounded(spark.read.parquet(f"{base}/out").drop("error"), "score")


@query(
    """SELECT event_id, (props ->> '$.k')::bigint AS k, NULL::double AS bmi, round(0.01 * (props ->> '$.k')::bigint, 6)::double AS score,
       CASE WHEN 0.01 * (props ->> '$.k')::bigint > 0.5 THEN 'HIGH RISK' ELSE 'LOW RISK' END AS risk_level FROM events"""
)
def stream_answers_once(spark, sf):
    """Every request arrives twice, the second time after a restart of the stream; each is scored once."""
    events = table(spark, sf, "events")
    contract = T.StructType([T.StructField("k", T.LongType()), T.StructField("bmi", T.DoubleType())])

    def score(df):
        scored = df.withColumn("score", linear_score({"k": 0.01}))
        return scored.withColumn("risk_level", risk_level(F.col("score")))

    base = fresh_dir(spark, "stream")
    for _ in range(2):
        events.write.mode("append").parquet(f"{base}/in")
        arriving = request_stream(spark, f"{base}/in", events.schema)
        once = first_requests(arriving, ["user_id", "event_id"], "ts", "3650 days")
        run_available(score_requests(once, "props", contract, score, ["event_id"]), f"{base}/out", f"{base}/checkpoint")
    return rounded(spark.read.parquet(f"{base}/out").drop("error"), "score")
