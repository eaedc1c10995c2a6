"""Feature steps: fit on some rows, apply to any rows. A fitted step holds plain numbers.

Stage order: bins, date parts, derived columns, scaling, encoding, interactions, powers.
Later stages see what earlier ones made of a column.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.config import Bin, DateParts, FeatureConfig
from tabweave.functions.columns import (
    DATE_FORMATS,
    DATE_PARTS,
    NUMERIC_TYPES,
    bin_code,
    bin_label,
    check_edges,
    date_part,
    equal_width_edges,
    interaction,
    interval_labels,
    power,
    quoted,
    rescale,
    timestamp_of,
    typed_lit,
)
from tabweave.operators.encode import (
    DRIVER_KEYS,
    Dictionary,
    category_values,
    fit_sorted_codes,
    fit_target_means,
)
from tabweave.operators.quality import date_columns, normalise_missing
from tabweave.plans.ordered import exact_quantiles
from tabweave.session import lenient

log = logging.getLogger(__name__)

SCALE_METHODS = ("standard", "minmax", "robust", "maxabs")
ENCODE_METHODS = ("onehot", "label", "target")


class FeatureStep:
    """Base of all fitted steps. Subclass and register in STEPS to add one's own."""

    def transform(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def to_dict(self) -> dict[str, Any]:
        return {"step": type(self).__name__, **asdict(self)}

    @classmethod
    def from_dict(cls, d: dict[str, Any]) -> "FeatureStep":
        return cls(**d)


@dataclass
class BinStep(FeatureStep):
    column: str
    edges: list[float]
    labels: list[str]
    output: str
    code_column: str | None = None

    def transform(self, df):
        out = df.withColumn(self.output, bin_label(quoted(self.column), self.edges, self.labels))
        if self.code_column:
            out = out.withColumn(self.code_column, bin_code(quoted(self.column), self.edges))
        return out


@dataclass
class DateStep(FeatureStep):
    column: str
    parts: list[str]
    formats: list[str] = field(default_factory=lambda: list(DATE_FORMATS))

    def transform(self, df):
        parsed = quoted(self.column) if self.column in date_columns(df) else timestamp_of(self.column, self.formats)
        out = df.withColumn(self.column, parsed)
        return out.select(
            *[quoted(c) for c in out.columns if c not in self._names()],
            *[date_part(quoted(self.column), p).alias(f"{self.column}_{p}") for p in self.parts],
        )

    def _names(self):
        return {f"{self.column}_{p}" for p in self.parts}


@dataclass
class DerivedStep(FeatureStep):
    """A new column. Where an expression has no value, as a quotient by zero, it is null instead of an error."""

    name: str
    expression: str | Callable

    def transform(self, df):
        with lenient(df.sparkSession):
            value = self.expression(df) if callable(self.expression) else F.expr(self.expression)
            return df.withColumn(self.name, value)

    def to_dict(self):
        if callable(self.expression):
            raise ValueError(f"{self.name}: only a SQL expression can be saved")
        return super().to_dict()


@dataclass
class ScaleStep(FeatureStep):
    method: str
    stats: dict[str, list[float]]

    def transform(self, df):
        return df.select(
            *[
                rescale(quoted(c), *self.stats[c]).alias(c) if c in self.stats else quoted(c)
                for c in df.columns
            ]
        )


@dataclass
class OneHotStep(FeatureStep):
    categories: dict[str, list[Any]]

    def transform(self, df):
        rest = [quoted(c) for c in df.columns if c not in self.categories]
        made = []
        for c, values in self.categories.items():
            for v in values[1:]:
                hit = F.coalesce(quoted(c) == typed_lit(v, df.schema[c].dataType), F.lit(False))
                made.append(hit.cast("int").alias(f"{c}_{v}"))
        return df.select(*rest, *made)

    def to_dict(self):
        shown = {c: [v if isinstance(v, (str, int, float, bool)) else str(v) for v in vs] for c, vs in self.categories.items()}
        return {"step": "OneHotStep", "categories": shown}


@dataclass
class CodeStep(FeatureStep):
    dictionaries: dict[str, Dictionary]

    def transform(self, df):
        for d in self.dictionaries.values():
            df = d.apply(df)
        return df

    def to_dict(self):
        return {"step": "CodeStep", "dictionaries": {c: d.to_dict() for c, d in self.dictionaries.items()}}

    @classmethod
    def from_dict(cls, d):
        return cls({c: Dictionary.from_dict(x) for c, x in d["dictionaries"].items()})


@dataclass
class InteractionStep(FeatureStep):
    pairs: list[list[str]]

    def transform(self, df):
        return df.select("*", *[interaction(quoted(a), quoted(b)).alias(f"{a}_x_{b}") for a, b in self.pairs])


@dataclass
class PowerStep(FeatureStep):
    columns: list[str]
    degree: int

    def transform(self, df):
        made = [power(quoted(c), d).alias(f"{c}_power_{d}") for c in self.columns for d in range(2, self.degree + 1)]
        return df.select("*", *made)


STEPS: dict[str, type[FeatureStep]] = {
    s.__name__: s
    for s in (BinStep, DateStep, DerivedStep, ScaleStep, OneHotStep, CodeStep, InteractionStep, PowerStep)
}


@dataclass
class FittedFeatures:
    """The fitted steps in order. ``transform`` is a chain of projections."""

    steps: list[FeatureStep] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        df = normalise_missing(df) if self.steps else df
        for s in self.steps:
            df = s.transform(df)
        return df

    def to_json(self) -> str:
        return json.dumps([s.to_dict() for s in self.steps])

    @staticmethod
    def from_json(text: str) -> "FittedFeatures":
        steps = []
        for d in json.loads(text):
            kind = STEPS[d.pop("step")]
            steps.append(kind.from_dict(d))
        return FittedFeatures(steps)


# ------------------------------------------------------------------- fitting


def fit_bin(df: DataFrame, b: Bin) -> BinStep:
    edges = b.bins
    if isinstance(edges, int):
        lo, hi = df.agg(F.min(quoted(b.column).cast("double")), F.max(quoted(b.column).cast("double"))).first()
        if lo is None:
            raise ValueError(f"{b.column} has no value to cut into {edges} bins")
        edges = equal_width_edges(lo, hi, edges)
    check_edges(edges, b.labels)
    labels = list(b.labels) if b.labels is not None else interval_labels(list(edges))
    if not isinstance(df.schema[b.column].dataType, NUMERIC_TYPES):
        raise TypeError(f"{b.column} is not numeric and cannot be binned")
    return BinStep(b.column, list(edges), labels, b.output, b.code_column)


def date_failures(df: DataFrame, dates: Sequence[DateParts]) -> dict[str, int]:
    """Values of each text column that are no date, all columns in one pass."""
    todo = [d for d in dates if d.column in df.columns and d.column not in date_columns(df)]
    if not todo:
        return {}
    bad = [F.count_if(quoted(d.column).isNotNull() & timestamp_of(d.column, d.formats).isNull()) for d in todo]
    return {d.column: n for d, n in zip(todo, df.agg(*bad).first())}


def fit_dates(df: DataFrame, d: DateParts, failures: dict[str, int] | None = None) -> DateStep:
    """Strict: one value that is no date fails the column. ``failures``: what ``date_failures`` found."""
    wrong = (date_failures(df, [d]) if failures is None else failures).get(d.column)
    if wrong:
        raise ValueError(f"{d.column} has {wrong} values that are no timestamp")
    return DateStep(d.column, [p for p in DATE_PARTS if p in d.extract], list(d.formats))


def fit_scale(df: DataFrame, method: str, columns: Sequence[str]) -> ScaleStep:
    """Centre and spread of all columns in one pass (robust: the quantile passes)."""
    for c in columns:
        if not isinstance(df.schema[c].dataType, (*NUMERIC_TYPES, T.BooleanType)):
            raise ValueError(f"{c} is not numeric and cannot be scaled")
    if method == "robust":
        qs = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
        stats = {c: [q[1] or 0.0, (q[2] or 0.0) - (q[0] or 0.0)] for c, q in qs.items()}
        return ScaleStep(method, {c: [m, s or 1.0] for c, (m, s) in stats.items()})
    clean = normalise_missing(df.select(*[quoted(c).cast("double").alias(c) for c in columns]))
    aggs = []
    for c in columns:
        v = quoted(c)
        aggs.append(F.struct(F.avg(v), F.stddev_pop(v), F.min(v), F.max(v), F.max(F.abs(v))))
    out = {}
    for c, (mean, std, lo, hi, top) in zip(columns, clean.agg(*aggs).first()):
        if mean is None:
            out[c] = [0.0, 1.0]
        elif method == "standard":
            out[c] = [mean, std if hi > lo else 1.0]
        elif method == "minmax":
            out[c] = [lo, (hi - lo) or 1.0]
        else:
            out[c] = [0.0, top or 1.0]
    return ScaleStep(method, out)


def fit_onehot(df: DataFrame, columns: Sequence[str], ordered: dict[str, list[str]] | None = None) -> OneHotStep:
    """Sorted categories per column, one output column for each but the first, as many as there are."""
    ordered = ordered or {}
    values = category_values(df, [c for c in columns if c not in ordered])
    return OneHotStep({c: list(ordered[c]) if c in ordered else values[c] for c in columns})


def fit_features(df: DataFrame, cfg: FeatureConfig) -> FittedFeatures:
    """Fit all enabled stages on ``df``; statistics are fetched, rows are not."""
    fitted = FittedFeatures()
    if not cfg.enabled:
        return fitted
    df = normalise_missing(df)
    ordered: dict[str, list[str]] = {}

    def add(step: FeatureStep) -> None:
        nonlocal df
        df = step.transform(df)
        fitted.steps.append(step)

    def tolerant(what: str, make: Callable[[], FeatureStep]) -> FeatureStep | None:
        try:
            step = make()
            step.transform(df).schema  # analysis errors of the step surface here
        except Exception as e:
            if cfg.on_error == "raise":
                raise
            log.error("%s skipped: %s", what, str(e).partition("\n")[0])
            return None
        add(step)
        return step

    for b in cfg.bins:
        if b.column not in df.columns:
            log.warning("column %s not found for binning", b.column)
            continue
        step = tolerant(f"binning {b.column}", lambda: fit_bin(df, b))
        if step is not None:
            ordered[step.output] = step.labels
    failures = date_failures(df, cfg.dates)
    for d in cfg.dates:
        if d.column not in df.columns:
            log.warning("column %s not found for date parts", d.column)
            continue
        tolerant(f"date parts of {d.column}", lambda: fit_dates(df, d, failures))
    for x in cfg.derived:
        tolerant(f"derived column {x.name}", lambda: DerivedStep(x.name, x.expression))
        ordered.pop(x.name, None)

    scaled = [c for c in cfg.scale_columns if c in df.columns]
    if scaled:
        if cfg.scale_method in SCALE_METHODS:
            add(fit_scale(df, cfg.scale_method, scaled))
        else:
            log.warning("unknown scaling method %s", cfg.scale_method)
    coded = [c for c in cfg.encode_columns if c in df.columns]
    if coded:
        add_encoding(df, cfg, coded, ordered, add)
    pairs = [list(p) for p in cfg.interactions if len(p) == 2 and p[0] in df.columns and p[1] in df.columns]
    if pairs:
        _need_numbers(df, [c for p in pairs for c in p])
        add(InteractionStep(pairs))
    powers = [c for c in cfg.power_columns if c in df.columns]
    if powers:
        _need_numbers(df, powers)
        add(PowerStep(powers, cfg.power_degree))
    return fitted


def add_encoding(df: DataFrame, cfg: FeatureConfig, columns: list[str], ordered, add) -> None:
    if cfg.encode_method == "onehot":
        add(fit_onehot(df, columns, ordered))
    elif cfg.encode_method == "label":
        known = {c: ordered[c] for c in columns if c in ordered}
        add(CodeStep(fit_sorted_codes(df, columns, known, driver_keys=DRIVER_KEYS)))
    elif cfg.encode_method == "target":
        if cfg.label is None:
            raise ValueError("target encoding needs the label column")
        add(CodeStep(fit_target_means(df, columns, cfg.label)))
    else:
        log.warning("unknown encoding method %s", cfg.encode_method)


def _need_numbers(df: DataFrame, columns: Sequence[str]) -> None:
    for c in columns:
        if not isinstance(df.schema[c].dataType, (*NUMERIC_TYPES, T.BooleanType)):
            raise TypeError(f"{c} is not numeric")
