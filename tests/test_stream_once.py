import datetime as dt

from tabweave.streaming.scoring import first_requests, request_stream, run_available

SCHEMA = "client string, id long, at timestamp, body string"


def _at(minute):
    return dt.datetime(2024, 5, 1, 12) + dt.timedelta(minutes=minute)


def _arrive(spark, base, rows):
    """Write a batch, start the stream anew on its checkpoint and return all answers so far."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = request_stream(spark, f"{base}/in", spark.createDataFrame([], SCHEMA).schema)
    run_available(first_requests(stream, ["client", "id"], "at", "30 minutes"), f"{base}/out", f"{base}/checkpoint")
    return sorted(r["body"] for r in spark.read.parquet(f"{base}/out").collect())


def test_repeats_are_answered_once_over_restarts(spark, tmp_path):
    base = str(tmp_path)
    first = [("a", 1, _at(0), "x"), ("a", 2, _at(1), "y"), ("b", 1, _at(2), "z")]
    assert _arrive(spark, base, first) == ["x", "y", "z"]
    again = [("a", 1, _at(5), "x"), ("b", 1, _at(6), "z"), ("a", 3, _at(7), "v"), ("a", 3, _at(7), "v")]
    assert _arrive(spark, base, again) == ["v", "x", "y", "z"]


def test_requests_without_key_or_time_all_pass_and_late_ones_go(spark, tmp_path):
    base = str(tmp_path)
    odd = [(None, 1, _at(0), "p"), (None, 1, _at(0), "p"), ("a", None, _at(1), "q"), ("a", 9, None, "r"), ("a", 1, _at(90), "x")]
    assert _arrive(spark, base, odd) == ["p", "p", "q", "r", "x"]
    # The watermark stands at minute 60: what is older is not answered.
    assert _arrive(spark, base, [("c", 1, _at(10), "late"), ("c", 2, _at(80), "s")]) == ["p", "p", "q", "r", "s", "x"]


def test_on_a_table(spark):
    rows = [("a", 1, _at(0), "x"), ("a", 1, _at(9), "x"), (None, 1, _at(0), "p"), (None, 1, _at(0), "p")]
    got = first_requests(spark.createDataFrame(rows, SCHEMA), ["client", "id"], "at", "1 minute")
    assert sorted(r["body"] for r in got.collect()) == ["p", "p", "x"]
