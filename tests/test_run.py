import json

import pytest
from pyspark.sql import functions as F

from tabweave.config import ConfigError, load_config
from tabweave.operators import explain as E
from tabweave.operators import models as G
from tabweave.operators.search import Candidate
from tabweave.plans.run import run_training
from tabweave.sources.readers import synthetic
from tabweave.sources.versions import read_version
from tabweave.sources.writers import write_delimited


@pytest.fixture(scope="module")
def config(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    rows = synthetic(spark, 300, 4).withColumn("group", F.when(F.col("age") > 0, "old").otherwise("young"))
    write_delimited(rows.drop("row_id").withColumnRenamed("target", "y"), str(root / "t.csv"))
    cfg = {
        "experiment": {"name": "e"},
        "data": {
            "input_path": str(root / "t.csv"),
            "dataset_name": "t",
            "dataset_root": str(root / "registry"),
            "label_column": "y",
            "validation": {"check_duplicates": True},
        },
        "feature_engineering": {
            "custom": {"enabled": True, "transformations": [{"name": "ratio", "expression": "age / (abs(bmi) + 1)"}]},
            "scaling": {"enabled": True, "columns": ["cholesterol"]},
        },
        "compute": {"cluster_name": "c"},
        "automl": {"task": "classification", "primary_metric": "accuracy", "training": {"n_cross_validations": 2}},
        "output": {
            "preprocessed_data_path": str(root / "prepared"),
            "model_path": str(root / "models"),
            "generate_explanations": True,
            "explanations_output_path": str(root / "why"),
        },
    }
    (root / "c.json").write_text(json.dumps(cfg))
    return load_config(str(root / "c.json"))


def test_run_writes_everything(spark, config):
    got = run_training(spark, config, candidates=[Candidate("lr", "logistic_regression", {})])
    assert got.version == 1 and read_version(spark, config["data"]["dataset_root"], "t").count() == 300
    assert got.found.leaderboard.where("metric = 'accuracy'").first()["value"] > 0.8
    assert set(got.paths) >= {"preprocessed", "model", "importance", "values"}
    assert spark.read.parquet(got.paths["importance"]).count() == len(got.found.model.features)
    again = G.load_trained(spark, got.paths["model"])
    raw = spark.read.parquet(got.paths["preprocessed"])
    scored = again.score(raw, ["row_key", "y"])
    assert scored.agg(F.avg((F.col("y") == F.col("prediction")).cast("int"))).first()[0] > 0.8


def test_yaml_config(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text("data:\n  label_column: y\n")
    assert load_config(str(tmp_path / "c.yaml")) == {"data": {"label_column": "y"}}


def test_bad_config_stops_the_run(spark):
    with pytest.raises(ConfigError):
        run_training(spark, {"data": {}})


@pytest.mark.parametrize(
    "kind,params,output",
    [
        ("logistic_regression", {}, "margin"),
        ("random_forest", {"numTrees": 3, "maxDepth": 3}, "p1"),
        ("gradient_boosting", {"maxIter": 2, "maxDepth": 2}, "margin"),
    ],
)
def test_attribution_follows_the_model_family(spark, kind, params, output):
    rows = synthetic(spark, 120, 3).withColumnRenamed("target", "y").cache()
    names = ["age", "bmi", "blood_pressure"]
    t = G.train(rows, names, "y", kind, **params)
    a = E.attribute_model(t, rows, ["row_id"])
    total = sum((a.phi(f) for f in names), F.col("base_value"))
    p1 = a.df.select("row_id", total.alias("total")).join(t.score(rows, ["row_id"]), "row_id")
    if output == "p1":
        want = F.col("total")
    else:
        steep = 2.0 if kind == "gradient_boosting" else 1.0
        want = 1 / (1 + F.exp(-steep * F.col("total")))
    assert p1.agg(F.max(F.abs(want - F.col("p1")))).first()[0] < 1e-9


def test_attribution_of_several_classes_is_model_agnostic(spark):
    rows = synthetic(spark, 60, 3).withColumn("y", F.when(F.col("age") > 0.5, 2).otherwise(F.col("target"))).cache()
    names = ["age", "bmi"]
    t = G.train(rows, names, "y", "logistic_regression", scale=False)
    a = E.attribute_model(t, rows, ["row_id"], rows.limit(5))
    total = sum((a.phi(f) for f in names), F.col("base_value"))
    both = a.df.select("row_id", total.alias("total")).join(t.score(rows, ["row_id"]), "row_id")
    assert both.agg(F.max(F.abs(F.col("total") - F.col("p1")))).first()[0] < 1e-9


def test_regression_run_fits_on_the_training_part(spark, config, tmp_path):
    cfg = json.loads(json.dumps(config))
    cfg["data"] = {**cfg["data"], "label_column": "cholesterol"}
    del cfg["data"]["dataset_root"]
    cfg["feature_engineering"]["scaling"] = {"enabled": True, "columns": ["bmi"]}
    cfg["automl"] = {
        "task": "regression",
        "primary_metric": "r2_score",
        "training": {"validation_size": 0.3},
        "ensemble": {"ensemble_iterations": 2},
    }
    cfg["output"] = {"model_path": str(tmp_path / "models")}
    some = [Candidate("line", "linear_regression", {}), Candidate("trees", "random_forest", {"numTrees": 3, "maxDepth": 3})]
    got = run_training(spark, cfg, candidates=some)
    board = {r["model"]: r["value"] for r in got.found.leaderboard.where("metric = 'r2'").collect()}
    assert board.keys() == {"line", "trees", "voting_ensemble"} and len(got.found.members) == 2
    assert "split" not in got.found.model.features and "split" not in got.table.columns
    everywhere = run_training(spark, {**cfg, "data": {**cfg["data"], "fit_on_all_rows": True}}, candidates=some[:1])
    scaled = [r.table.agg(F.avg("bmi")).first()[0] for r in (got, everywhere)]
    assert abs(scaled[1]) < 1e-9 < abs(scaled[0])


def test_forecasting_run(spark, config, tmp_path):
    days = spark.range(120).select(F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("day"), (10.0 + F.col("id") % 7).alias("sold"))
    write_delimited(days, str(tmp_path / "t.csv"))
    cfg = {
        "experiment": {"name": "e"},
        "data": {"input_path": str(tmp_path / "t.csv"), "dataset_name": "t", "label_column": "sold"},
        "compute": {"cluster_name": "c"},
        "automl": {
            "task": "forecasting",
            "primary_metric": "r2_score",
            "training": {"experiment_timeout_minutes": 5, "validation_size": 0.2},
            "forecasting": {"time_column_name": "day", "forecast_horizon": 14},
        },
        "output": {},
    }
    got = run_training(spark, cfg, candidates=[Candidate("trees", "random_forest", {"numTrees": 5, "maxDepth": 5})])
    assert got.found.leaderboard.where("metric = 'r2'").first()["value"] > 0.9 and "lag_7" in got.found.model.features
    with pytest.raises(ConfigError):
        run_training(spark, {**cfg, "automl": {**cfg["automl"], "forecasting": {}}})
