import os
import time

import pytest
from pyspark.sql import functions as F

from tabweave.operators.models import auto_features
from tabweave.plans.flow import prepare_from_config
from tabweave.sources import readers as R
from tabweave.sources import versions as V
from tabweave.sources import writers as W


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return str(path)


def test_types_are_found_like_a_flat_file_reader_does(spark, tmp_path):
    p = put(tmp_path / "t.csv", 'n,gap,f,b,t,d,z\n1,1,1.5,True,None,2024-01-01,\n02,NA,2,False,x,2024-01-02,\n3,,nan,TRUE,"a ""q""\nb",,\n')
    df = R.read_table(spark, p, line_breaks_in_quotes=True)
    assert dict(df.dtypes) == {"n": "bigint", "gap": "double", "f": "double", "b": "boolean", "t": "string", "d": "string", "z": "double"}
    rows = df.orderBy("n").collect()
    assert [r["t"] for r in rows] == ["None", "x", 'a "q"\nb']
    assert [r["gap"] for r in rows] == [1.0, None, None] and rows[2]["f"] is None


def test_null_tokens_are_a_parameter(spark, tmp_path):
    p = put(tmp_path / "t.csv", "t\nNone\nNA\nx\n")
    assert sorted(r[0] or "" for r in R.read_delimited(spark, p).collect()) == ["", "None", "x"]
    strict = R.read_delimited(spark, p, null_tokens=("None",))
    assert sorted(r[0] or "" for r in strict.collect()) == ["", "NA", "x"]


def test_schema_read_is_lazy_and_strict(spark, tmp_path):
    p = put(tmp_path / "t.csv", "b,a\nx,1\ny,2\n")
    assert R.read_delimited(spark, p, schema="a bigint").agg(F.sum("a")).first()[0] == 3
    with pytest.raises(ValueError):
        R.read_delimited(spark, p, schema="c int")
    with pytest.raises(Exception):
        R.read_delimited(spark, p, schema="b bigint").collect()


def test_formats_and_paths(spark, tmp_path):
    with pytest.raises(ValueError):
        R.read_table(spark, "x.xlsx")
    a = put(tmp_path / "m" / "a.tsv", "k\tv\n1\tx\n")
    b = put(tmp_path / "m" / "b.tsv", "k\tv\n2\ty\n")
    assert R.read_delimited(spark, [a, b], sep="\t", encoding="ascii").count() == 2
    assert R.read_table(spark, a).first()["v"] == "x"
    assert R.peek_schema(spark, a, label="v") == ["k"]
    spark.range(3).write.parquet(str(tmp_path / "p.parquet"))
    out = R.read_table(spark, str(tmp_path / "p.parquet"), path_column="path")
    assert out.columns == ["id", "path"]
    assert R.peek_schema(spark, str(tmp_path / "p.parquet")) == ["id"]


def test_latest_and_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        os.makedirs(tmp_path / "e")
        R.read_latest(spark, str(tmp_path / "e"))
    old = put(tmp_path / "d" / "z.csv", "a\n1\n")
    put(tmp_path / "d" / "a.csv", "a\n2\n")
    put(tmp_path / "d" / "note.txt", "zz")
    os.utime(old, (time.time() - 1000,) * 2)
    assert R.read_latest(spark, str(tmp_path / "d")).first()["a"] == 2
    assert R.read_folder(spark, str(tmp_path / "d")).count() == 2
    with pytest.raises(FileNotFoundError):
        R.read_folder(spark, str(tmp_path / "e"))


def test_versions(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        V.read_version(spark, root, "t")
    assert [V.register(spark.range(n), root, "t") for n in (1, 2, 3)] == [1, 2, 3]
    assert V.read_version(spark, root, "t", 2).count() == 2
    assert V.read_version(spark, root, "t", "latest").count() == 3
    os.makedirs(tmp_path / "t" / "version=9")  # a write that never finished
    assert V.list_versions(spark, root, "t") == [1, 2, 3]
    assert V.parse_dataset_id("scheme:t:2") == ("t", 2) and V.parse_dataset_id("t:2") is None
    base = {"dataset_root": root, "dataset_name": "t"}
    assert V.read_registered(spark, {**base, "dataset_id": "scheme:t:1"}).count() == 1
    assert V.read_registered(spark, {**base, "dataset_id": "scheme:zz:1", "dataset_version": "2"}).count() == 2
    assert V.read_registered(spark, base).count() == 3


def test_writers(spark, frame, tmp_path):
    df = frame([(1, "a,b", None), (2, "", 'q"\n')], "id int, t string, u string")
    path = W.write_prepared(df, str(tmp_path), "csv", "20240101_000000")
    assert path.endswith("preprocessed_20240101_000000")
    back = R.read_delimited(spark, path, schema=df.schema, null_tokens=(), line_breaks_in_quotes=True).orderBy("id").collect()
    assert [tuple(r) for r in back] == [(1, "a,b", None), (2, "", 'q"\n')]
    with pytest.raises(ValueError):
        W.write_prepared(df, str(tmp_path), "xlsx")
    log = str(tmp_path / "log")
    for run in ("r1", "r2"):
        W.log_metrics(W.tall(spark.range(2).agg(F.count("*").alias("n"), F.avg("id").alias("m"))), log, run)
    assert spark.read.parquet(log).count() == 4


def test_synthetic(spark):
    df = R.synthetic(spark, 500, 17)
    assert len(df.columns) == 19 and df.columns[16] == "feature_15"
    assert df.agg(F.avg("target")).first()[0] == pytest.approx(0.5, abs=0.1)
    assert R.synthetic(spark, 50, 10).columns[1:11] == list(R.SYNTHETIC_NAMES[:10])
    same = R.synthetic(spark, 50, 3, "regression").collect()
    assert same == R.synthetic(spark, 50, 3, "regression").collect()
    with pytest.raises(ValueError):
        R.synthetic(spark, 5, 3, "x")


def test_run_from_config(spark, tmp_path):
    p = put(tmp_path / "t.csv", "AGE,BMI,ID,empty\n45,22.0,1,\n45,22.0,1,\n72,32.5,2,\n")
    cfg = {
        "data": {"input_path": p, "validation": {"check_duplicates": True}, "columns_to_drop": ["ID"], "label_column": "y"},
        "feature_engineering": {
            "binning": {"enabled": True, "features": [{"column": "AGE", "bins": [0, 40, 55, 70, 120], "labels": ["Y", "M", "S", "E"], "new_column": "G"}]},
            "custom": {"enabled": True, "transformations": [{"name": "r", "expression": "AGE / (BMI + 1)"}]},
        },
    }
    out, _ = prepare_from_config(spark, cfg)
    assert out.columns == ["AGE", "BMI", "G", "r"]
    assert [tuple(r) for r in out.orderBy("AGE").collect()] == [(45, 22.0, "M", 45 / 23), (72, 32.5, "E", 72 / 33.5)]
    V.register(out, str(tmp_path / "reg"), "t")
    again, _ = prepare_from_config(spark, {"data": {"use_existing_dataset": True, "dataset_root": str(tmp_path / "reg"), "dataset_name": "t"}})
    assert again.count() == 2


def test_auto_features_obey_the_config(frame):
    from tabweave.config import SearchConfig

    df = frame(
        [(1, "a", None, "2024-01-01", "7", True), (0, "b", 3.0, "2024-01-08", "8", None), (1, None, 5.0, None, "9", False)],
        "y int, k string, v double, d string, s string, b boolean",
    )
    cfg = SearchConfig(
        column_purposes={"d": "DateTime", "s": "Numeric"},
        blocked_transformers=("OneHotEncoder",),
        transformer_params={"Imputer": {"strategy": "median"}},
        drop_columns=("zz",),
    )
    out = auto_features(df, "y", search=cfg).transform(df)
    assert out.columns == ["y", "k", "v", "s", "b", *[f"d_{p}" for p in ("year", "month", "day", "dayofweek", "quarter", "hour")]]
    assert [r["k"] for r in out.collect()] == [1.0, 2.0, 0.0]
    assert [r["v"] for r in out.collect()] == [4.0, 3.0, 5.0]
    assert [r["d_dayofweek"] for r in out.collect()] == [0.0, 0.0, 0.0]
