"""The whole preparation of a table: read, validate, drop columns, build features."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession

from tabweave.config import FeatureConfig, ValidationConfig
from tabweave.operators.features import FittedFeatures, fit_features
from tabweave.operators.quality import drop_columns, validated
from tabweave.session import written


def prepare(
    df: DataFrame,
    validation: ValidationConfig | None = None,
    columns_to_drop=None,
    features: FeatureConfig | None = None,
    fit_rows: Column | None = None,
) -> tuple[DataFrame, FittedFeatures]:
    """Validate, drop, then fit and apply features.

    ``fit_rows`` selects the rows that statistics come from (the training part);
    without it all rows count. The result is lazy. Statistics need several passes, so a table
    that lost duplicates is written once to the shared folder instead of being compared in each.
    """
    shuffled = False
    if validation is not None:
        df, shuffled = validated(df, validation)
    df = drop_columns(df, columns_to_drop)
    if features is None or not features.enabled:
        return df, FittedFeatures()
    if shuffled and features.needs_statistics():
        df = written(df, "validated")
    fitted = fit_features(df if fit_rows is None else df.where(fit_rows), features)
    return fitted.transform(df), fitted


def prepare_from_config(
    spark: SparkSession, cfg: Mapping[str, Any], fit_rows: Column | None = None, mark: Callable[[DataFrame], DataFrame] | None = None
):
    """The same, from a run config. An empty validation section skips validation.

    ``mark`` adds columns to the validated rows before features are fitted; ``fit_rows`` may use them.

    A registered table (``use_existing_dataset``) is taken as it is, without preparation.
    """
    from tabweave.sources.readers import read_table
    from tabweave.sources.versions import read_registered

    data = cfg["data"]
    if data.get("use_existing_dataset", False):
        rows = read_registered(spark, data)
        return rows if mark is None else mark(rows), FittedFeatures()
    df = read_table(spark, data["input_path"])
    section = data.get("validation") or {}
    validation = ValidationConfig.from_dict(section) if section else None
    features = FeatureConfig.from_dict(cfg.get("feature_engineering") or {}, data.get("label_column"))
    if mark is None:
        return prepare(df, validation, data.get("columns_to_drop"), features, fit_rows)
    clean, _ = prepare(df, validation, data.get("columns_to_drop"))
    return prepare(mark(clean), None, None, features, fit_rows)
