import math

import pytest
from pyspark.sql import functions as F

from tabweave.config import ConfigError, FeatureConfig, ValidationConfig, check_config
from tabweave.operators import quality as Q
from tabweave.plans.flow import prepare


def test_nan_counts_as_missing_everywhere(frame):
    df = frame([(1, "x"), (1, "x"), (None, None), (None, None)], "a int, b string")
    assert Q.drop_duplicate_rows(df).count() == 2
    nan = frame([(float("nan"),), (None,), (1.0,), (3.0,)], "v double")
    assert Q.drop_duplicate_rows(nan).count() == 3
    assert Q.null_profile(nan).first()["n_null"] == 2
    assert sorted(r[0] for r in Q.impute(nan, ["v"], "median").collect()) == [1.0, 2.0, 2.0, 3.0]
    assert sorted(r[0] for r in Q.fill_constant(nan, 0).collect()) == [0.0, 0.0, 1.0, 3.0]


@pytest.mark.parametrize("limit", ["-1", "10m"])
def test_duplicates_with_and_without_broadcast(spark, limit, request):
    """No duplicates, and a hot row that is a third of the table."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    unique = spark.range(90).select("id", (F.col("id") * 0.5).alias("v"))
    kept, changed = Q._deduplicated(unique)
    assert kept is unique and not changed
    hot = F.col("id") % 3 == 0
    rows = spark.range(90).select(
        F.when(hot, None).otherwise(F.col("id") % 40).alias("k"),
        F.when(hot, F.when(F.col("id") % 2 == 0, 0.0).otherwise(-0.0)).otherwise(F.lit(1.0)).alias("v"),
        F.when(hot, "x").alias("s"),
    )
    got = Q.drop_duplicate_rows(rows)
    assert got.columns == rows.columns
    assert got.count() == rows.distinct().count() == got.distinct().count()


def test_sparse_columns_strictly_above_the_limit(frame):
    df = frame([(1, None, None), (2, None, 1), (3, 1, None), (4, 1, None)], "id int, half int, most int")
    assert Q.sparse_columns(df, 50) == ["most"]
    assert Q.sparse_columns(df.where("id > 9"), 50) == []


def test_validate_drops_columns_before_duplicates(frame):
    df = frame([(1, None), (1, None), (1, 5), (2, None)], "a int, b int")
    assert sorted(r[0] for r in Q.validate(df).collect()) == [1, 2]
    assert Q.validate(df, ValidationConfig(enabled=False)).count() == 4
    assert Q.validate(df, ValidationConfig(check_missing_values=False)).count() == 3


def test_columns_by_exact_name(frame, spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        check_exact_names(frame)
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def check_exact_names(frame):
    df = frame([(1, 2, True, "t")], "a int, A int, b boolean, s string")
    assert Q.drop_columns(df, ["a", "zz"]).columns == ["A", "b", "s"]
    assert Q.drop_columns(df, None).columns == df.columns
    assert Q.numeric_columns(df) == ["a", "A"]
    assert Q.text_columns(df) == ["s"] and Q.boolean_columns(df) == ["b"]
    assert Q.dtype_counts(df) == {"int": 2, "boolean": 1, "string": 1}
    with pytest.raises(ValueError):
        Q.features_and_label(df, "S")


@pytest.mark.parametrize("name", ["CVD_RISK", "target", "label", "y", "MACE"])
def test_target_aliases(frame, name):
    assert Q.rename_target(frame([(1, 2)], f"f int, {name} int"), "MACE").columns == ["f", "MACE"]


def test_no_target(frame):
    with pytest.raises(ValueError):
        Q.rename_target(frame([(1,)], "f int"), "MACE")


def test_imputation_strategies(frame):
    df = frame([("b", 1.0), ("a", 2.0), ("a", None), ("b", 9.0), (None, None)], "k string, v double")
    assert Q.impute_values(df, ["v"], "mean") == {"v": 4.0}
    assert Q.impute_values(df, ["v"], "median") == {"v": 2.0}
    assert Q.impute_values(df, ["k"], "most_frequent") == {"k": "a"}
    with pytest.raises(ValueError):
        Q.impute_values(df, ["v"], "zero")


def test_median_of_whole_numbers_may_be_a_fraction(frame):
    df = frame([(1,), (2,), (None,)], "n int")
    assert sorted(r[0] for r in Q.impute(df, ["n"]).collect()) == [1.0, 1.5, 2.0]


def test_summaries(frame):
    df = frame([(1, "a"), (3, "a"), (3, None), (None, "b")], "n int, k string")
    assert {tuple(r) for r in Q.value_counts(df, "k").collect()} == {("a", 2), ("b", 1)}
    assert [tuple(r) for r in Q.class_counts(df, "n").orderBy("class").collect()] == [(0, 0), (1, 1), (2, 0), (3, 2)]
    d = Q.describe(df, ["n"]).first()
    assert d["count"] == 3 and d["median"] == 3.0 and d["q25"] == 2.0 and math.isclose(d["std"], 2 / math.sqrt(3))
    assert tuple(Q.duplicate_count(df).first()) == (4, 4, 0)
    assert tuple(Q.shape(df).first()) == (4, 2)


def test_bad_dates_become_null(frame):
    df = frame([("2023-01-15",), ("zz",), (None,)], "d string")
    got = [r[0] for r in Q.coerce_timestamps(df, ["d", "e"]).collect()]
    assert str(got[0]) == "2023-01-15 00:00:00" and got[1:] == [None, None]


def test_prepare_fits_on_training_rows_only(frame):
    df = frame([(1, 0.0), (2, 2.0), (3, 100.0)], "id int, v double")
    cfg = FeatureConfig(scale_method="minmax", scale_columns=("v",))
    out, _ = prepare(df, None, None, cfg, F.col("id") < 3)
    assert sorted(r["v"] for r in out.collect()) == [0.0, 1.0, 50.0]


GOOD = {
    "experiment": {"name": "e"},
    "data": {"input_path": "x.csv", "dataset_name": "d", "label_column": "y"},
    "compute": {"cluster_name": "c"},
    "automl": {"task": "regression", "primary_metric": "rmse", "training": {"experiment_timeout_minutes": 1, "validation_size": 0.2}},
    "output": {},
}


def test_config_checks():
    assert check_config(GOOD) == []
    assert check_config({**GOOD, "data": {"use_existing_dataset": True, "dataset_name": "d", "label_column": "y"}}) == []
    bad = {
        "experiment": {},
        "data": {"label_column": 3},
        "automl": {"task": "x", "featurization": {"mode": "y"}},
        "feature_engineering": {
            "binning": {"enabled": True, "features": [{"column": "a", "bins": [1, 2], "labels": ["x", "y"]}, {"column": "b"}]},
            "datetime_features": {"enabled": True, "columns": [{"column": "d"}, {"column": "d", "extract": ["week"]}]},
            "interactions": {"enabled": True, "feature_pairs": [["a"]]},
            "custom": {"enabled": True, "transformations": [{"name": "n"}]},
        },
    }
    with pytest.raises(ConfigError) as e:
        check_config(bad)
    assert len(e.value.problems) == 15
