"""A whole training run from a config: prepare, keep, search, save, explain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.config import SearchConfig, check_config
from tabweave.functions.columns import quoted
from tabweave.operators.explain import attribute_model, explain_all
from tabweave.operators.features import FittedFeatures
from tabweave.operators.forecasting import fit_forecaster, rolling
from tabweave.operators.models import Trained, auto_features, numeric_label, save_trained, series_features
from tabweave.operators.search import Candidate, SearchResult, search
from tabweave.operators.split import split_by_bucket
from tabweave.plans.flow import prepare_from_config
from tabweave.session import written
from tabweave.sources.versions import register
from tabweave.sources.writers import run_stamp, write_prepared


@dataclass
class RunResult:
    table: DataFrame
    features: FittedFeatures
    found: SearchResult
    paths: dict[str, str] = field(default_factory=dict)
    version: int | None = None
    warnings: list[str] = field(default_factory=list)


def run_training(
    spark: SparkSession,
    cfg: Mapping[str, Any],
    keys: Sequence[str] | None = None,
    candidates: Sequence[Candidate] | None = None,
) -> RunResult:
    """Check the config, prepare the table, search models, and write what ``output`` asks for.

    ``keys`` identify a row for splits and explanations. Without them a hash of all columns
    does, for which the validation should drop duplicates. With a validation part instead of folds,
    features and encoders are fitted on the training part only, unless ``data.fit_on_all_rows`` says
    otherwise; folds share one preparation. Output goes below the paths
    ``preprocessed_data_path``, ``model_path`` and ``explanations_output_path``; a
    ``dataset_root`` in ``data`` registers the prepared table as a new version.
    """
    warnings = check_config(cfg)
    data, out = cfg["data"], cfg.get("output") or {}
    label = data["label_column"]
    stamp = run_stamp()
    paths: dict[str, str] = {}
    how = SearchConfig.from_dict(cfg["automl"])
    keep = list(keys or ["row_key"])
    parted = not how.folds and how.task != "forecasting" and not data.get("fit_on_all_rows", False)

    def marked(rows: DataFrame) -> DataFrame:
        """Rows with their key and, where preparation is fitted on one part, the part."""
        if keys is None:
            rows = rows.withColumn("row_key", F.xxhash64(*[quoted(c) for c in rows.columns]))
        if parted:
            rows = split_by_bucket(rows, keep, round(100 * (how.validation_size or 0.2)), method="xxhash64")
        return rows

    table, _ = prepare_from_config(spark, cfg, F.col("split") == "train" if parted else None, marked)
    # Search reads the table many times, so it starts from files.
    if out.get("save_preprocessed_data", True) and out.get("preprocessed_data_path"):
        paths["preprocessed"] = write_prepared(table, out["preprocessed_data_path"], stamp=stamp)
        table = spark.read.parquet(paths["preprocessed"])
    else:
        table = written(table, "prepared")
    version = None
    if data.get("dataset_root") and not data.get("use_existing_dataset", False):
        version = register(table, data["dataset_root"], data["dataset_name"])

    if how.task == "forecasting":
        if how.series_column is None:
            table, how = table.withColumn("series", F.lit("all")), replace(how, series_column="series")
        history = table
        made = series_features(table, how.series_column, how.time_column, label, how.period)
        table = made.withColumns({"month": F.month("period"), "weekday": F.weekday("period")}).withColumnRenamed("y", label)
        keep = [how.series_column, "period"]
        table = table.dropna(subset=[c for c in table.columns if c not in keep])
    table, _ = numeric_label(table, label) if how.task == "classification" else (table, None)
    extra = ["split"] if parted else []
    fit_rows = table.where("split = 'train'") if parted else table
    auto = FittedFeatures() if how.featurization == "off" else auto_features(fit_rows, label, [*keep, *extra], how)
    ready = auto.transform(table)
    features = [c for c in ready.columns if c != label and c not in keep and c not in extra]
    judge = None
    if how.task == "forecasting":
        where = (how.series_column, how.time_column, label, how.period)

        def judge(rows: DataFrame, c: Candidate) -> DataFrame:
            """Forecasts from rolling cut-offs; lags of a period ahead are the forecasts before it, never its true past."""
            return rolling(history, *where, how.horizon, how.folds or 1, kind=c.kind, **c.params).withColumnRenamed("y", label)

    found = search(ready, keep, features, label, how, candidates, split="split" if parted else None, judge=judge)
    if how.task == "forecasting" and out.get("forecast_path"):
        best_kind = found.best
        ahead = fit_forecaster(history, *where, kind=best_kind.kind, **best_kind.params).ahead(history, how.horizon)
        paths["forecast"] = write_prepared(ahead, out["forecast_path"], stamp=stamp)
    ready, table = ready.drop(*extra), table.drop(*extra)
    best = found.model
    if out.get("register_model", True) and out.get("model_path"):
        paths["model"] = f"{out['model_path'].rstrip('/')}/{out.get('model_name', 'model')}_{stamp}"
        whole = Trained(
            FittedFeatures([*auto.steps, *best.preparation.steps]),
            best.features,
            label,
            best.task,
            best.kind,
            best.model,
            table.drop(label).schema,
        )
        save_trained(whole, paths["model"], table)
    if out.get("generate_explanations", False) and out.get("explanations_output_path"):
        folder = f"{out['explanations_output_path'].rstrip('/')}/{stamp}"
        paths |= explain_all(attribute_model(best, ready, keep), folder)
    return RunResult(table, auto, found, paths, version, warnings)
