"""The declarative run config as frozen dataclasses, with argument checks on the driver."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame

from tabweave.functions.columns import DATE_FORMATS, DATE_PARTS

TASKS = ("regression", "classification", "forecasting")
FEATURIZATION_MODES = ("auto", "custom", "off")
SECTIONS = ("experiment", "data", "compute", "automl")


class ConfigError(ValueError):
    """All problems of a config at once."""

    def __init__(self, problems: Sequence[str]):
        super().__init__("; ".join(problems))
        self.problems = list(problems)


@dataclass(frozen=True)
class Bin:
    column: str
    bins: Sequence[float] | int
    labels: Sequence[str] | None = None
    new_column: str | None = None
    code_column: str | None = None

    @property
    def output(self) -> str:
        return self.new_column or f"{self.column}_binned"


@dataclass(frozen=True)
class DateParts:
    column: str
    extract: Sequence[str] = ()
    formats: Sequence[str] = DATE_FORMATS


@dataclass(frozen=True)
class Derived:
    """A new column from a SQL expression, or from a function of the DataFrame."""

    name: str
    expression: str | Callable[[DataFrame], Column]


@dataclass(frozen=True)
class FeatureConfig:
    enabled: bool = True
    bins: Sequence[Bin] = ()
    dates: Sequence[DateParts] = ()
    derived: Sequence[Derived] = ()
    scale_method: str = "standard"
    scale_columns: Sequence[str] = ()
    encode_method: str = "onehot"
    encode_columns: Sequence[str] = ()
    interactions: Sequence[Sequence[str]] = ()
    power_degree: int = 2
    power_columns: Sequence[str] = ()
    label: str | None = None
    on_error: str = "skip"

    def needs_statistics(self) -> bool:
        """Whether fitting reads the rows at all."""
        widths = any(isinstance(b.bins, int) for b in self.bins)
        return bool(widths or self.dates or self.scale_columns or self.encode_columns)

    @staticmethod
    def from_dict(cfg: Mapping[str, Any], label: str | None = None, on_error: str = "skip") -> "FeatureConfig":
        """Read the ``feature_engineering`` section; each part counts only if enabled."""

        def part(name: str) -> Mapping[str, Any]:
            section = cfg.get(name) or {}
            return section if section.get("enabled", False) else {}

        custom = [t for t in part("custom").get("transformations") or [] if t.get("name") and t.get("expression")]
        scaling, encoding, poly = part("scaling"), part("encoding"), part("polynomial")
        return FeatureConfig(
            enabled=cfg.get("enabled", True),
            bins=tuple(
                Bin(f.get("column"), f.get("bins"), f.get("labels"), f.get("new_column"), f.get("code_column"))
                for f in part("binning").get("features") or []
            ),
            dates=tuple(
                DateParts(c.get("column"), tuple(c.get("extract") or ()), tuple(c.get("formats") or DATE_FORMATS))
                for c in part("datetime_features").get("columns") or []
            ),
            derived=tuple(Derived(t["name"], t["expression"]) for t in custom),
            scale_method=scaling.get("method", "standard"),
            scale_columns=tuple(scaling.get("columns") or ()),
            encode_method=encoding.get("method", "onehot"),
            encode_columns=tuple(encoding.get("columns") or ()),
            interactions=tuple(tuple(p) for p in part("interactions").get("feature_pairs") or []),
            power_degree=poly.get("degree", 2),
            power_columns=tuple(poly.get("columns") or ()),
            label=label,
            on_error=on_error,
        )


@dataclass(frozen=True)
class ValidationConfig:
    enabled: bool = True
    check_missing_values: bool = True
    max_missing_percentage: float = 50
    check_duplicates: bool = True

    @staticmethod
    def from_dict(cfg: Mapping[str, Any]) -> "ValidationConfig":
        names = ("enabled", "check_missing_values", "max_missing_percentage", "check_duplicates")
        return ValidationConfig(**{k: cfg[k] for k in names if k in cfg})


@dataclass(frozen=True)
class SearchConfig:
    """Model search: what to try, how to judge it, when to stop."""

    task: str = "classification"
    primary_metric: str = "auc_weighted"
    folds: int | None = None
    validation_size: float | None = None
    allowed: Sequence[str] = ()
    blocked: Sequence[str] = ()
    timeout_minutes: float | None = None
    trial_timeout_minutes: float | None = None
    max_trials: int | None = None
    parallel_trials: int = 1
    early_stopping: bool = False
    featurization: str = "auto"
    blocked_transformers: Sequence[str] = ()
    column_purposes: Mapping[str, str] = field(default_factory=dict)
    drop_columns: Sequence[str] = ()
    transformer_params: Mapping[str, Any] = field(default_factory=dict)
    vote_members: int = 0
    time_column: str | None = None
    series_column: str | None = None
    horizon: str = "7 days"
    period: str = "day"

    @staticmethod
    def from_dict(automl: Mapping[str, Any]) -> "SearchConfig":
        training = automl.get("training") or {}
        feat = automl.get("featurization") or {}
        models = automl.get("models") or {}
        return SearchConfig(
            task=automl["task"],
            primary_metric=automl["primary_metric"],
            folds=training.get("n_cross_validations"),
            validation_size=training.get("validation_size"),
            allowed=tuple(models.get("allowed") or ()),
            blocked=tuple(models.get("blocked") or ()),
            timeout_minutes=training.get("experiment_timeout_minutes"),
            trial_timeout_minutes=training.get("iteration_timeout_minutes"),
            max_trials=training.get("max_trials"),
            parallel_trials=training.get("max_concurrent_iterations", 1),
            early_stopping=training.get("enable_early_stopping", False),
            featurization=feat.get("mode", "auto"),
            blocked_transformers=tuple(feat.get("blocked_transformers") or ()),
            column_purposes=dict(feat.get("column_purposes") or {}),
            drop_columns=tuple(feat.get("drop_columns") or ()),
            transformer_params=dict(feat.get("transformer_params") or {}),
            vote_members=int((automl.get("ensemble") or {}).get("ensemble_iterations", 0)),
            time_column=(automl.get("forecasting") or {}).get("time_column_name"),
            series_column=(automl.get("forecasting") or {}).get("time_series_id_column_name"),
            horizon=f"{(automl.get('forecasting') or {}).get('forecast_horizon', 7)} {(automl.get('forecasting') or {}).get('frequency', 'day')}s",
            period=(automl.get("forecasting") or {}).get("frequency", "day"),
        )


def load_config(path: str) -> dict[str, Any]:
    """Read a run config from a JSON or YAML file on the driver."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("YAML configs need the yaml package; JSON configs do not") from e
    return yaml.safe_load(text)


def check_config(cfg: Mapping[str, Any]) -> list[str]:
    """Raise ConfigError for wrong entries; return the warnings.

    A table read by registered name needs no ``input_path``.
    """
    errors: list[str] = [f"missing section {s!r}" for s in SECTIONS if s not in cfg]
    warnings: list[str] = []
    experiment, data = cfg.get("experiment"), cfg.get("data")
    if experiment is not None and not isinstance(experiment.get("name"), str):
        errors.append("experiment.name must be a string")
    if data is not None:
        if not data.get("use_existing_dataset", False) and "input_path" not in data:
            errors.append("data.input_path is required")
        for key in ("dataset_name", "label_column"):
            if not isinstance(data.get(key), str):
                errors.append(f"data.{key} must be a string")
    _check_features(cfg.get("feature_engineering") or {}, errors, warnings)
    if cfg.get("compute") is not None and "cluster_name" not in cfg["compute"]:
        errors.append("compute.cluster_name is required")
    if cfg.get("automl") is not None:
        _check_search(cfg["automl"], errors, warnings)
    if "output" not in cfg:
        warnings.append("no output section, defaults apply")
    if errors:
        raise ConfigError(errors)
    return warnings


def _check_features(fe: Mapping[str, Any], errors: list[str], warnings: list[str]) -> None:
    def on(name: str) -> Mapping[str, Any]:
        section = fe.get(name) or {}
        return section if section.get("enabled", False) else {}

    for i, f in enumerate(on("binning").get("features") or []):
        missing = [k for k in ("column", "bins", "labels") if k not in f]
        errors.extend(f"binning.features[{i}]: {k} is required" for k in missing)
        if not missing and isinstance(f["bins"], (list, tuple)) and len(f["labels"]) != len(f["bins"]) - 1:
            errors.append(f"binning.features[{i}]: {len(f['bins'])} edges need {len(f['bins']) - 1} labels")
    for i, c in enumerate(on("datetime_features").get("columns") or []):
        errors.extend(f"datetime_features.columns[{i}]: {k} is required" for k in ("column", "extract") if k not in c)
        warnings.extend(
            f"datetime_features.columns[{i}]: unknown part {p!r}" for p in c.get("extract") or () if p not in DATE_PARTS
        )
    for i, pair in enumerate(on("interactions").get("feature_pairs") or []):
        if not isinstance(pair, (list, tuple)) or len(pair) != 2:
            errors.append(f"interactions.feature_pairs[{i}]: needs exactly two columns")
    for i, t in enumerate(on("custom").get("transformations") or []):
        errors.extend(f"custom.transformations[{i}]: {k} is required" for k in ("name", "expression") if k not in t)


def _check_search(automl: Mapping[str, Any], errors: list[str], warnings: list[str]) -> None:
    if automl.get("task") not in TASKS:
        errors.append(f"automl.task must be one of {', '.join(TASKS)}")
    if automl.get("task") == "forecasting" and not (automl.get("forecasting") or {}).get("time_column_name"):
        errors.append("automl.forecasting.time_column_name is required")
    if "primary_metric" not in automl:
        errors.append("automl.primary_metric is required")
    training = automl.get("training")
    if training is None:
        errors.append("automl.training is required")
    else:
        if "experiment_timeout_minutes" not in training:
            warnings.append("automl.training.experiment_timeout_minutes is not set")
        if "n_cross_validations" not in training and "validation_size" not in training:
            warnings.append("set n_cross_validations or validation_size")
    mode = (automl.get("featurization") or {}).get("mode")
    if mode is not None and mode not in FEATURIZATION_MODES:
        errors.append(f"automl.featurization.mode must be one of {', '.join(FEATURIZATION_MODES)}")
