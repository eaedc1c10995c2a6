import json
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.operators import scoring as P
from tabweave.sources.readers import parse_requests, parse_split_requests
from tabweave.streaming.scoring import request_stream, run_available, score_requests



def test_align(frame):
    contract = T.StructType.fromDDL("age bigint, label string, bmi double, admitted timestamp_ntz")
    df = frame([("x", 3, 1.5)], "extra string, age int, bmi float")
    out = P.align(df, contract)
    assert out.schema.simpleString() == contract.simpleString()
    assert tuple(out.first()) == (3, None, 1.5, None)


def test_json_rows_keep_nulls_and_iso_dates(frame):
    df = frame([(1, float("nan"), None, "2023-01-15"), (2, 1.5, 'q"', None)], "a int, b double, c string, d string")
    df = df.withColumn("d", F.col("d").cast("timestamp_ntz"))
    got = [json.loads(r[0]) for r in P.json_rows(df).collect()]
    assert got == [{"a": 1, "b": None, "c": None, "d": "2023-01-15T00:00:00"}, {"a": 2, "b": 1.5, "c": 'q"', "d": None}]


def test_split_requests_round_trip(frame):
    df = frame([(1, 22.0, 'a "b" \n{"v":1}', None), (2, None, "None", True)], "id int, bmi double, label string, flag boolean")
    sent = P.split_rows(df, ["id"], "body").orderBy("id")
    first = json.loads(sent.first()["body"])["input_data"]
    assert first == {"index": [0], "columns": ["bmi", "label", "flag"], "data": [[22.0, 'a "b" \n{"v":1}', None]]}
    schema = T.StructType.fromDDL("label string, bmi double, other int, flag boolean")
    got = parse_split_requests(sent, "body", schema, ["id"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [
        (1, 0, 'a "b" \n{"v":1}', 22.0, None, None, None),
        (2, 0, "None", None, None, True, None),
    ]


def test_split_request_with_several_rows_and_bad_bodies(frame):
    body = '{"input_data":{"columns":["b","a"],"data":[[1.5,2],[null,3]]}}'
    df = frame([(1, body), (2, "oops"), (3, None), (4, "{}")], "id int, body string")
    got = parse_split_requests(df, "body", T.StructType.fromDDL("a int, b double"), ["id"]).orderBy("id", "row").collect()
    assert [(r["id"], r["a"], r["b"], r["error"] is None) for r in got] == [
        (1, 2, 1.5, True),
        (1, 3, None, True),
        (2, None, None, False),
        (3, None, None, False),
        (4, None, None, False),
    ]


def test_bad_requests_become_error_rows(frame):
    rows = [(1, '{"age": 4, "label": "x"}'), (2, '{"age": '), (3, None), (4, '{"age": "four"}')]
    got = parse_requests(frame(rows, "id int, body string"), "body", T.StructType.fromDDL("age bigint, label string"), ["id"])
    assert [(r["id"], r["age"], r["error"] is None) for r in got.orderBy("id").collect()] == [
        (1, 4, True),
        (2, None, False),
        (3, None, False),
        (4, None, False),
    ]


def test_probability_shapes(frame):
    df = frame([(1, 0.25, 3.0), (0, 1.0, 1.0)], "p int, a double, b double")
    out = df.select(*P.label_as_proba(F.col("p")), *P.pseudo_proba(F.col("p")), *P.repair_proba([F.col("a"), F.col("b")]))
    assert [tuple(r) for r in out.collect()] == [
        (0.0, 1.0, 0.05, 0.95, 0.25 / 3.25, 3.0 / 3.25),
        (1.0, 0.0, 0.95, 0.05, 0.5, 0.5),
    ]
    single = df.select(*P.repair_proba([F.col("a")], renormalise=False)).first()
    assert tuple(single) == (0.75, 0.25)
    zero = df.select(*P.repair_proba([F.lit(0.0), F.lit(0.0)])).first()
    assert tuple(zero) == (None, None)


@pytest.mark.parametrize(
    "low,high,verdict",
    [(0.1, 0.9, "higher risk identified"), (0.5, 0.5, "same risk"), (0.9, 0.1, "expected difference not shown"), (None, 0.3, "missing case")],
)
def test_compare_cases(frame, low, high, verdict):
    df = frame([("lo", low), ("hi", high)], "c string, s double")
    got = P.compare_cases(df, "c", "s", "lo", "hi").first()
    assert got["verdict"] == verdict
    assert low is None or math.isclose(got["difference"], high - low)


def test_no_model():
    with pytest.raises(ValueError):
        P.predict(None, None)
    with pytest.raises(ValueError):
        P.predict_proba(None, None, [])


def doubler():
    class Doubler:
        def predict(self, frame):
            return frame["x"] * 2 + frame["y"]

        def predict_proba(self, frame):
            return frame["x"] / 10

    return Doubler


def test_python_model_methods(frame):
    df = frame([(1, 2.0, 1.0), (2, 3.0, 0.0)], "id int, x double, y double").repartition(2)
    Doubler = doubler()
    got = P.score_with_python(df, Doubler, ["x", "y"], ["id"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, 5.0), (2, 6.0)]
    proba = P.score_with_python(df, Doubler, ["x"], ["id", "x"], "predict_proba", "p").orderBy("id").collect()
    assert [r["p"] for r in proba] == [0.2, 0.3]


def test_stream_scores_each_request_once_over_restarts(spark, frame, tmp_path):
    source, sink, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = T.StructType.fromDDL("id int, body string")
    contract = T.StructType.fromDDL("x double")

    def run():
        stream = request_stream(spark, source, schema, files_per_batch=1)
        scored = score_requests(stream, "body", contract, lambda d: d.withColumn("score", F.col("x") * 2), ["id"])
        run_available(scored, sink, mark)
        return sorted((r["id"], r["score"], r["error"] is None) for r in spark.read.parquet(sink).collect())

    frame([(1, '{"x": 1}'), (2, "bad")], "id int, body string").write.parquet(source)
    assert run() == [(1, 2.0, True), (2, None, False)]
    frame([(3, '{"x": 3}')], "id int, body string").write.mode("append").parquet(source)
    assert run() == [(1, 2.0, True), (2, None, False), (3, 6.0, True)]
