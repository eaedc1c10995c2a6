"""Scoring: the column contract, prediction and probability shapes, JSON rows, Python models."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import OneVsRestModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.functions.columns import nan_to_null, quoted, risk_level, truthy_label
from tabweave.operators.boosting import SoftmaxBoostModel
from tabweave.operators.models import with_probabilities


def align(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The contract's columns in its order and types: missing -> null, extra -> dropped."""
    have = set(df.columns)
    return df.select(
        *[
            (quoted(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in contract.fields
        ]
    )


def json_rows(df: DataFrame, output: str = "json") -> DataFrame:
    """Each row as JSON text: NaN and missing as null, timestamps as ISO text."""
    return df.select(F.to_json(F.struct(*_plain_columns(df)), {"ignoreNullFields": "false"}).alias(output))


def _plain_columns(df: DataFrame) -> list[Column]:
    out = []
    for f in df.schema.fields:
        c = quoted(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = nan_to_null(c)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = _iso(c, f.dataType)
        out.append(c.alias(f.name))
    return out


def _iso(c: Column, kind: T.DataType) -> Column:
    text = (c.cast("timestamp_ntz") if isinstance(kind, T.DateType) else c).cast("string")
    whole = F.replace(F.substring(text, 1, 19), F.lit(" "), F.lit("T"))
    micros = F.rpad(F.substring(text, 21, 6), 6, "0")
    return F.when(F.length(text) > 19, F.concat(whole, F.lit("."), micros)).otherwise(whole)


def split_rows(df: DataFrame, keys: Sequence[str], output: str = "json") -> DataFrame:
    """Each row as a one-record request ``{"input_data": {"index", "columns", "data"}}``.

    Values keep their JSON types: the data list is cut from the row's own JSON.
    """
    features = [c for c in df.columns if c not in keys]
    body = df.select(*[quoted(c) for c in features])
    cells = [
        F.coalesce(F.regexp_replace(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":(.*)\}$', "$1"), F.lit("null"))
        for c in _plain_columns(body)
    ]
    # to_json leaves a null field out, which leaves "{}".
    cells = [F.when(c == "{}", F.lit("null")).otherwise(c) for c in cells]
    names = F.to_json(F.array(*[F.lit(c) for c in features]))
    text = F.concat(
        F.lit('{"input_data":{"index":[0],"columns":'), names, F.lit(',"data":[['), F.concat_ws(",", *cells), F.lit("]]}}")
    )
    return df.select(*[quoted(k) for k in keys], text.alias(output))


# ---------------------------------------------------------------- predictions


def last_stage(model: Model) -> Model:
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def predict(model: Model | None, df: DataFrame) -> DataFrame:
    if model is None:
        raise ValueError("no fitted model")
    return model.transform(df)


def predict_proba(model: Model | None, df: DataFrame, keep: Sequence[str], task: str = "classification") -> DataFrame:
    """Class probabilities as p0, p1, ...; without a probability output [1 - p, p] from the label."""
    if model is None:
        raise ValueError("no fitted model")
    if task != "classification":
        raise ValueError("probabilities exist only for classification")
    whole = model if isinstance(model, PipelineModel) else PipelineModel(stages=[model])
    scored, classes = with_probabilities(whole, df)
    if classes:
        probs = [F.col("_proba")[i].alias(f"p{i}") for i in range(classes)]
    else:
        probs = [c.alias(f"p{i}") for i, c in enumerate(label_as_proba(F.col("prediction")))]
    return scored.select(*[quoted(k) for k in keep], *probs)


def has_probability(model: Model) -> bool:
    last = last_stage(model)
    return isinstance(last, (OneVsRestModel, SoftmaxBoostModel)) or hasattr(last, "getProbabilityCol") and hasattr(last, "numClasses")


def proba_or_predict(model: Model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Probabilities where the model has them, else its prediction."""
    if has_probability(model):
        return predict_proba(model, df, keep)
    return predict(model, df).select(*[quoted(k) for k in keep], "prediction")


def label_as_proba(prediction: Column) -> tuple[Column, Column]:
    p = prediction.cast("double")
    return F.lit(1.0) - p, p


def pseudo_proba(prediction: Column) -> tuple[Column, Column]:
    """0.95 for the predicted class, 0.05 for the other."""
    return (
        F.when(prediction == 0, F.lit(0.95)).otherwise(F.lit(0.05)),
        F.when(prediction == 1, F.lit(0.95)).otherwise(F.lit(0.05)),
    )


def repair_proba(p: Sequence[Column], renormalise: bool = True) -> list[Column]:
    """One probability becomes two; rows are scaled to sum to 1 (null where they sum to 0)."""
    cols = [F.lit(1.0) - p[0], p[0]] if len(p) == 1 else list(p)
    if not renormalise:
        return cols
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return [F.try_divide(c, total) for c in cols]


def as_label(prediction: Column) -> Column:
    return truthy_label(prediction)


def compare_cases(df: DataFrame, case: str, score: str, low, high) -> DataFrame:
    """Scores of two cases, their difference, and whether the high one scores higher."""
    lo = F.max(F.when(quoted(case) == F.lit(low), quoted(score).cast("double")))
    hi = F.max(F.when(quoted(case) == F.lit(high), quoted(score).cast("double")))
    both = df.agg(lo.alias("low_score"), hi.alias("high_score"))
    d = F.col("high_score") - F.col("low_score")
    verdict = (
        F.when(d.isNull(), F.lit("missing case"))
        .when(d > 0, F.lit("higher risk identified"))
        .when(d == 0, F.lit("same risk"))
        .otherwise(F.lit("expected difference not shown"))
    )
    return both.select("low_score", "high_score", d.alias("difference"), verdict.alias("verdict"))


def with_risk(df: DataFrame, score: str, output: str = "risk_level") -> DataFrame:
    return df.withColumn(output, risk_level(quoted(score)))


# -------------------------------------------------------------- Python models


def score_with_python(
    df: DataFrame,
    load: Callable[[], Any],
    features: Sequence[str],
    keep: Sequence[str],
    method: str = "predict",
    output: str = "prediction",
) -> DataFrame:
    """Score with any Python object that has ``predict`` (or another method) on a pandas frame.

    ``load`` runs once per task, on the executor; rows stream through in Arrow batches.
    """
    columns = list(features)
    kept = [df.schema[k] for k in keep]
    schema = T.StructType([*kept, T.StructField(output, T.DoubleType())])
    kept_names = list(keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        if model is None:
            raise ValueError("no fitted model")
        call = getattr(model, method)
        for pdf in batches:
            out = pdf[kept_names].copy()
            out[output] = pd.Series(call(pdf[columns]), index=pdf.index, dtype="float64")
            yield out

    needed = list(dict.fromkeys([*keep, *features]))
    return df.select(*[quoted(c) for c in needed]).mapInPandas(run, schema)
