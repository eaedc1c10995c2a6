"""Training on Spark ML: preprocessing dialects, estimators, saved bundles, folds."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRestModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabweave.config import DateParts, SearchConfig
from tabweave.functions.columns import DATE_PARTS, quoted, typed_lit
from tabweave.operators.boosting import SoftmaxBoost, SoftmaxBoostModel
from tabweave.operators.cells import fit_by_cells, score_by_cells
from tabweave.operators.encode import columns_up_to, fit_first_seen_codes, fit_sorted_codes
from tabweave.operators.features import STEPS, CodeStep, FeatureStep, FittedFeatures, fit_dates, fit_onehot, fit_scale
from tabweave.operators.logistic import MOST_FEATURES, fit_by_newton
from tabweave.operators.quality import (
    boolean_columns,
    cast_columns,
    date_columns,
    drop_columns,
    fill_values,
    impute_values,
    normalise_missing,
    numeric_columns,
    require_columns,
    text_columns,
)
from tabweave.session import enable_checkpoints, written

# Columns that carry no feature in the explanation dialect.
NON_FEATURES = (
    "RACE_LABEL", "ETHNICITY_DETAILED", "ADMITDATE", "PROC_DATE", "DISCHARGEDATE",
    "TOBACCO_STATUS_LABEL", "ALCOHOL_STATUS_LABEL", "ILL_DRUG_STATUS_LABEL", "LAST_MED_ENC_TYPE",
)


@dataclass
class DropStep(FeatureStep):
    columns: list[str]

    def transform(self, df):
        return drop_columns(df, self.columns)


@dataclass
class CastStep(FeatureStep):
    kinds: dict[str, str]

    def transform(self, df):
        return cast_columns(df, self.kinds)


@dataclass
class FillStep(FeatureStep):
    values: dict[str, Any]

    def transform(self, df):
        return fill_values(df, self.values)


STEPS.update({s.__name__: s for s in (DropStep, CastStep, FillStep)})


@dataclass(frozen=True)
class Dialect:
    """How a trainer prepares raw columns."""

    text_fill: str | None
    first_seen: bool = False
    numeric_fill: str | int | None = None
    booleans_as_text: bool = False
    dates_as_text: bool = True
    drop: Sequence[str] = ()


DIALECTS = {
    "a": Dialect("MISSING", numeric_fill="median"),
    "b": Dialect("UNKNOWN", numeric_fill="median", booleans_as_text=True),
    "c": Dialect("nan"),
    "d": Dialect(None, first_seen=True, numeric_fill=0),
    "e": Dialect("UNKNOWN", numeric_fill=0, drop=NON_FEATURES),
}


def fit_dialect(df: DataFrame, dialect: str, label: str, order_by: str | None = None, keep: Sequence[str] = ()) -> FittedFeatures:
    """Fit one of the five preparations on ``df``; label and ``keep`` columns stay as they are."""
    if dialect not in DIALECTS:
        raise ValueError(f"unknown dialect {dialect!r}; known: {', '.join(DIALECTS)}")
    d = DIALECTS[dialect]
    df = normalise_missing(df)
    require_columns(df, [label])
    fixed = {label, *keep}
    steps: list[FeatureStep] = []

    def add(step: FeatureStep) -> None:
        nonlocal df
        df = step.transform(df)
        steps.append(step)

    gone = [c for c in d.drop if c in df.columns and c not in fixed]
    if gone:
        add(DropStep(gone))
    codes = [c for c in text_columns(df) if c not in fixed]
    if d.dates_as_text:
        codes += [c for c in date_columns(df) if c not in fixed]
    bools = [c for c in boolean_columns(df) if c not in fixed]
    if d.booleans_as_text:
        codes += bools
    elif bools:
        add(CastStep({c: "int" for c in bools}))
    codes = [c for c in df.columns if c in codes]
    if codes and d.first_seen:
        if order_by is None:
            raise ValueError("codes by first appearance need an order column")
        add(CodeStep(fit_first_seen_codes(df, codes, order_by)))
    elif codes:
        add(CodeStep(fit_sorted_codes(df, codes, fill=d.text_fill)))
    numbers = [c for c in numeric_columns(df) if c not in fixed]
    if d.numeric_fill == "median":
        values = impute_values(df, [c for c in numbers if c not in codes], "median")
        add(FillStep({c: v for c, v in values.items() if v is not None}))
    elif d.numeric_fill is not None:
        add(FillStep({c: d.numeric_fill for c in numbers}))
    add(CastStep({c: "double" for c in df.columns if c not in fixed}))
    return FittedFeatures(steps)


def numeric_label(df: DataFrame, label: str) -> tuple[DataFrame, dict[Any, int] | None]:
    """Label as double: booleans become 0/1, text becomes sorted codes (returned too)."""
    kind = df.schema[label].dataType
    if isinstance(kind, T.StringType):
        d = fit_sorted_codes(df, [label])[label]
        # One entry per class, which the caller names its predictions with.
        codes = dict(d.pairs) if d.pairs is not None else {r["key"]: r["value"] for r in d.entries(df.sparkSession).collect()}
        return d.apply(df).withColumn(label, quoted(label).cast("double")), codes
    if isinstance(kind, T.BooleanType):
        return df.withColumn(label, quoted(label).cast("int").cast("double")), None
    return df.withColumn(label, quoted(label).cast("double")), None


# ------------------------------------------------------------------ estimators

CLASSIFIERS = ("random_forest", "gradient_boosting", "logistic_regression")
REGRESSORS = ("random_forest", "gradient_boosting", "linear_regression")


def make_estimator(
    kind: str, task: str, label: str, n_rows: int, n_classes: int = 2, **params
) -> Estimator:
    """The Spark ML estimator of a named model with its default parameters; ``params`` overrule them.

    Trees split on at most ``maxBins`` quantile bins per feature, so that a node is found
    from histograms that are combined on the map side. Spark stops a tree at 30 levels and knows no
    least size of a node to split, so a forest keeps two rows per leaf instead.
    """
    common = {"featuresCol": "features", "labelCol": label}
    if task == "classification":
        if kind == "random_forest":
            return RandomForestClassifier(
                **common, **{"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 2, "seed": 42, **params}
            )
        if kind == "gradient_boosting":
            settings = {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "seed": 42, **params}
            return (GBTClassifier if n_classes <= 2 else SoftmaxBoost)(**common, **settings)
        if kind == "logistic_regression":
            c = params.pop("C", 1.0)
            # L2 with strength 1/C on the summed loss equals 1/(C n) on the mean loss.
            settings = {"maxIter": 1000, "regParam": 1.0 / (c * max(n_rows, 1)), "standardization": False, "tol": 1e-6}
            return LogisticRegression(**common, **{**settings, **params})
    elif task == "regression":
        if kind == "random_forest":
            settings = {"numTrees": 100, "featureSubsetStrategy": "all", "maxDepth": 30, "seed": 42}
            return RandomForestRegressor(**common, **{**settings, **params})
        if kind == "gradient_boosting":
            return GBTRegressor(**common, **{"maxIter": 100, "maxDepth": 3, "stepSize": 0.1, "seed": 42, **params})
        if kind == "linear_regression":
            # The normal equations: one pass, and a Gram matrix of up to 4096 features. For more ask for solver="l-bfgs".
            return LinearRegression(**common, **{"solver": "normal", "regParam": 0.0, **params})
    else:
        raise ValueError(f"unknown task {task!r}")
    raise ValueError(f"unknown model {kind!r} for {task}")


def with_probabilities(model: PipelineModel, df: DataFrame) -> tuple[DataFrame, int]:
    """Rows with ``prediction`` and, for a classifier, ``_proba`` (one probability per class); and the number of classes.

    Of one model per class against the rest, the probabilities of the classes are scaled to sum to 1.
    """
    last = model.stages[-1]
    if isinstance(last, SoftmaxBoostModel):
        return model.transform(df), last.numClasses
    if hasattr(last, "cell_values"):
        out = df
        for stage in model.stages[:-1]:
            out = stage.transform(out)
        return score_by_cells(last, out), getattr(last, "numClasses", 0)
    if not isinstance(last, OneVsRestModel):
        out = model.transform(df)
        if "probability" not in out.columns:
            return out, 0
        return out.withColumn("_proba", vector_to_array("probability")), last.numClasses
    out = df
    for stage in model.stages[:-1]:
        out = stage.transform(out)
    names = []
    for i, one in enumerate(last.models):
        one = one.copy()
        one.setRawPredictionCol(f"_raw{i}").setProbabilityCol(f"_prob{i}").setPredictionCol(f"_pred{i}")
        out = one.transform(out)
        names.append(vector_to_array(f"_prob{i}")[1])
    out = out.withColumn("_each", F.array(*names))
    total = F.aggregate("_each", F.lit(0.0), lambda s, p: s + p)
    out = out.withColumn("_proba", F.transform("_each", lambda p: F.coalesce(F.try_divide(p, total), F.lit(1.0 / len(names)))))
    best = (F.array_position("_proba", F.array_max("_proba")) - 1).cast("double")
    gone = ["_each", *[f"_{k}{i}" for i in range(len(names)) for k in ("raw", "prob", "pred")]]
    return out.withColumn("prediction", best).drop(*gone), len(names)


def _spread(vectors: DataFrame) -> DataFrame:
    """Rows of a few input files, over all cores; many partitions stay as they are."""
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    return vectors.repartition(cores) if vectors.rdd.getNumPartitions() < cores else vectors


@dataclass
class Trained:
    """Preparation, feature order and fitted model of one training run."""

    preparation: FittedFeatures
    features: list[str]
    label: str
    task: str
    kind: str
    model: PipelineModel
    contract: T.StructType = field(default_factory=T.StructType)

    def transform(self, df: DataFrame) -> DataFrame:
        """Prepared rows with prediction (and probability) columns."""
        return self.model.transform(self.preparation.transform(df))

    def score(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """The kept columns, the prediction and, for a classifier, a probability per class (p0, p1, ...)."""
        out, classes = with_probabilities(self.model, self.preparation.transform(df))
        return out.select(*[quoted(k) for k in keep], "prediction", *[F.col("_proba")[i].alias(f"p{i}") for i in range(classes)])


def train(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    kind: str,
    task: str = "classification",
    preparation: FittedFeatures | None = None,
    scale: bool | None = None,
    keep: bool = True,
    **params,
) -> Trained:
    """Fit a model on all rows of ``df``. Logistic regression scales its features first.

    Rows are kept for the passes over them; ``keep=False`` reads those of a long table anew, which costs no memory and no disk
    and is as fast where they come straight from files.
    """
    spark = df.sparkSession
    raw_contract = T.StructType([df.schema[c] for c in df.columns if c != label])
    steps = list(preparation.steps) if preparation else []
    ready = preparation.transform(df) if preparation else normalise_missing(df)
    feats = list(features)
    if scale is None:
        scale = kind == "logistic_regression"
    if scale:
        step = fit_scale(ready, "standard", feats)
        ready = step.transform(ready)
        steps.append(step)
    y = quoted(label).cast("double")
    rows = ready.select(*[quoted(c).cast("double").alias(c) for c in feats], y.alias(label))
    if kind in ("gradient_boosting", "random_forest"):
        enable_checkpoints(spark)
    assembler = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="error")
    # Training reads its rows many times; they are kept unless reading is cheap, so that the preparation runs once.
    grows = kind in ("gradient_boosting", "random_forest")
    as_columns = grows or (kind == "logistic_regression" and len(feats) <= MOST_FEATURES)
    kept = rows if as_columns else assembler.transform(rows).select("features", label)
    held = keep or not as_columns
    kept = _spread(kept).persist() if held else kept
    try:
        n, classes = kept.agg(F.count("*"), F.max(label)).first()
        n_classes = int(classes or 0) + 1 if task == "classification" else 0
        estimator = make_estimator(kind, task, label, n, n_classes, **params)
        # Trees of a long table are grown on its weighted cells, of a short one on its rows; a long logistic regression goes by Newton's steps.
        by_all = fit_by_cells if grows else fit_by_newton if as_columns else None
        fitted = by_all(estimator, kept, feats, label, n, n_classes) if by_all else None
        if fitted is None:
            # Spark's own training has many passes.
            kept = kept if held else _spread(kept).persist()
            fitted = estimator.fit(assembler.transform(kept).select("features", label) if as_columns else kept)
    finally:
        kept.unpersist()
    model = PipelineModel(stages=[assembler, fitted])
    return Trained(FittedFeatures(steps), feats, label, task, kind, model, raw_contract)


# --------------------------------------------------------------------- bundles


def save_trained(t: Trained, path: str, example: DataFrame | None = None) -> None:
    """Folder with the model, its preparation and schema as JSON, and five example rows.

    A large category dictionary is a table; it is copied into the folder and named by its place
    there, so that the folder may be moved.
    """
    spark = SparkSession.getActiveSession()
    base = path.rstrip("/")
    t.model.write().save(f"{base}/model")
    steps, copied = [], 0
    for s in t.preparation.steps:
        if isinstance(s, CodeStep):
            kept = {}
            for c, d in s.dictionaries.items():
                if d.table is not None:
                    place = f"dictionaries/{copied}"
                    copied += 1
                    spark.read.parquet(d.table).write.parquet(f"{base}/{place}")
                    d = replace(d, table=place)
                kept[c] = d
            s = CodeStep(kept)
        steps.append(s)
    meta = {
        "features": t.features,
        "label": t.label,
        "task": t.task,
        "kind": t.kind,
        "contract": t.contract.jsonValue(),
        "preparation": FittedFeatures(steps).to_json(),
        "example": example is not None,
    }
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{base}/meta")
    if example is not None:
        example.limit(5).write.parquet(f"{base}/example")


def load_trained(spark: SparkSession, path: str, verify: bool = True) -> Trained:
    base = path.rstrip("/")
    meta = json.loads(spark.read.text(f"{base}/meta").first()[0])
    preparation = FittedFeatures.from_json(meta["preparation"])
    for s in preparation.steps:
        for d in s.dictionaries.values() if isinstance(s, CodeStep) else ():
            d.table = d.table and f"{base}/{d.table}"
    t = Trained(
        preparation,
        meta["features"],
        meta["label"],
        meta["task"],
        meta["kind"],
        PipelineModel.load(f"{base}/model"),
        T.StructType.fromJson(meta["contract"]),
    )
    if verify and meta["example"]:
        example = spark.read.parquet(f"{base}/example").limit(1)
        if len(t.score(example, []).collect()) != example.count():
            raise RuntimeError(f"the model in {path} does not score its example row")
    return t


# ----------------------------------------------------------- folds, ensembles


def out_of_fold(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str, kind: str, task: str, fold: str, k: int, keep: bool = True, **params
) -> DataFrame:
    """Predictions for every row by a model that never saw its fold.

    The rows are written once, without other columns, and every fold reads them from there; with ``keep=False`` from ``df``.
    """
    if keep:
        df = written(df.select(*[quoted(c) for c in dict.fromkeys([*keys, *features, label, fold])]), "folds")
    parts = []
    for i in range(k):
        t = train(df.where(quoted(fold) != i), features, label, kind, task, keep=False, **params)
        held = df.where(quoted(fold) == i)
        parts.append(t.score(held, [*keys, label, fold]))
    return reduce(DataFrame.unionByName, parts)


def member_scores(models: Sequence[Trained], df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Add one column ``m<i>`` per model, the array of its class probabilities or of its one prediction: no join.

    The members take the same prepared columns, so none may carry its own preparation.
    """
    if any(t.preparation.steps for t in models):
        raise ValueError("ensemble members must share one preparation; train them on prepared rows")
    base = list(dict.fromkeys([*keep, *df.columns]))
    for i, t in enumerate(models):
        out, classes = with_probabilities(t.model, df)
        value = F.col("_proba") if classes else F.array("prediction")
        df = out.select(*[quoted(c) for c in base], *[F.col(f"m{j}") for j in range(i)], value.alias(f"m{i}"))
    return df


def vote(models: Sequence[Trained], df: DataFrame, keep: Sequence[str], task: str = "classification") -> DataFrame:
    """Average of the models' class probabilities (p0, p1, ... and the likeliest class) or of their predictions."""
    scored = member_scores(models, df, keep)
    members = F.array(*[F.col(f"m{i}") for i in range(len(models))])
    width = _classes(models[0]) if task == "classification" else 1

    def mean_of(c: int) -> Column:
        return F.aggregate(members, F.lit(0.0), lambda s, p: s + p[c]) / F.lit(float(len(models)))

    mean = [mean_of(c) for c in range(width)]
    kept = [quoted(k) for k in keep]
    if task != "classification":
        return scored.select(*kept, mean[0].alias("prediction"))
    out = scored.select(*kept, *[p.alias(f"p{c}") for c, p in enumerate(mean)])
    each = F.array(*[F.col(f"p{c}") for c in range(width)])
    return out.withColumn("prediction", (F.array_position(each, F.array_max(each)) - 1).cast("double"))


def _classes(t: Trained) -> int:
    last = t.model.stages[-1]
    return len(last.models) if isinstance(last, OneVsRestModel) else last.numClasses


def _member_columns(models: Sequence[Trained], scored: DataFrame, task: str) -> tuple[DataFrame, list[str]]:
    """The members' scores as numbers; the probability of the first class says nothing that the others do not."""
    made = {}
    for i, t in enumerate(models):
        for c in range(1, _classes(t)) if task == "classification" else (0,):
            made[f"m{i}_{c}"] = F.col(f"m{i}")[c]
    return scored.withColumns(made), list(made)


@dataclass
class Stack:
    """Members, the model on top of their scores, and the scaling that all members share."""

    base: list[Trained]
    top: Trained
    preparation: FittedFeatures = field(default_factory=FittedFeatures)

    def score(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        # What is kept stays as it was given, also where it is a feature.
        held = df.withColumn("_kept", F.struct(*[quoted(k) for k in keep])) if keep else df.withColumn("_kept", F.lit(0))
        scored, _ = _member_columns(self.base, member_scores(self.base, self.preparation.transform(held), ["_kept"]), self.top.task)
        out = self.top.score(scored, ["_kept"])
        return out.select(*[F.col("_kept").getField(k).alias(k) for k in keep], *[quoted(c) for c in out.columns if c != "_kept"])


def stack(
    df: DataFrame, features: Sequence[str], label: str, members: Sequence[tuple[str, dict]], fold: str, k: int, task: str = "classification"
) -> Stack:
    """A linear model on out-of-fold scores of the members, then members refitted on all rows.

    The scores of each fold are written once: training the model on top reads them many times. All members see features
    scaled once, without which a linear member needs hundreds of passes.
    """
    step = fit_scale(df, "standard", list(features))
    prepared = FittedFeatures([step])
    df = written(prepared.transform(df.select(*[quoted(c) for c in dict.fromkeys([*features, label, fold])])), "stack-rows")
    parts, names = [], []
    keep = [label, fold]
    for i in range(k):
        rest, held = df.where(quoted(fold) != i), df.where(quoted(fold) == i)
        fitted = [train(rest, features, label, kind, task, scale=False, **p) for kind, p in members]
        scored = member_scores(fitted, held.select(*[quoted(c) for c in dict.fromkeys([*keep, *features])]), keep)
        wide, names = _member_columns(fitted, scored, task)
        parts.append(written(wide.select(*names, quoted(label)), "fold-scores"))
    level1 = reduce(DataFrame.unionByName, parts)
    top_kind = "logistic_regression" if task == "classification" else "linear_regression"
    top = train(level1, names, label, top_kind, task)
    return Stack([train(df, features, label, kind, task, scale=False, **p) for kind, p in members], top, prepared)


# --------------------------------------------------------- automatic features


def auto_features(
    df: DataFrame, label: str, keep: Sequence[str] = (), search: SearchConfig | None = None, onehot_up_to: int = 20
) -> FittedFeatures:
    """Type-driven preparation: impute numbers, split dates, one-hot columns for text of at most ``onehot_up_to``
    values (counted, not estimated) and codes for other text. The fitted steps keep the decision.

    ``search`` (a SearchConfig) may drop columns, force a purpose per column, block the
    imputer or an encoder, and set the imputation strategy.
    """
    df = normalise_missing(df)
    purposes = dict(search.column_purposes) if search else {}
    blocked = set(search.blocked_transformers) if search else set()
    fixed = {label, *keep}
    steps: list[FeatureStep] = []

    def add(step: FeatureStep) -> None:
        nonlocal df
        df = step.transform(df)
        steps.append(step)

    gone = [c for c in (search.drop_columns if search else ()) if c in df.columns]
    if gone:
        add(DropStep(gone))
    bools = [c for c in boolean_columns(df) if c not in fixed]
    if bools:
        add(CastStep({c: "int" for c in bools}))
    names = [c for c in df.columns if c not in fixed]
    dates = [c for c in names if purposes.get(c) == "DateTime" or (c not in purposes and c in date_columns(df))]
    for c in dates:
        add(fit_dates(df, DateParts(c, tuple(DATE_PARTS))))
    if dates:
        add(DropStep(dates))
    texts = [
        c for c in names if c not in dates and (purposes.get(c) == "Categorical" or (c not in purposes and c in text_columns(df)))
    ]
    forced = [c for c in names if purposes.get(c) == "Numeric" and c in text_columns(df)]
    if forced:
        add(CastStep({c: "double" for c in forced}))
        texts = [c for c in texts if c not in forced]
    if texts:
        few = [] if "OneHotEncoder" in blocked else columns_up_to(df, texts, onehot_up_to)
        many = [c for c in texts if c not in few]
        if many:
            add(CodeStep(fit_sorted_codes(df, many, fill="UNKNOWN")))
        if few:
            add(fit_onehot(df, few))
    numbers = [c for c in numeric_columns(df) if c not in fixed]
    if numbers and "Imputer" not in blocked:
        params = (search.transformer_params if search else {}).get("Imputer") or {}
        values = impute_values(df, numbers, params.get("strategy", "mean"))
        add(FillStep({c: v for c, v in values.items() if v is not None}))
    add(CastStep({c: "double" for c in df.columns if c not in fixed}))
    return FittedFeatures(steps)


def boosted_after_auto(df: DataFrame, label: str, keep: Sequence[str] = (), **params) -> Trained:
    """Automatic features, scaling by the largest absolute value, boosted trees."""
    prep = auto_features(df, label, keep)
    ready = prep.transform(df)
    feats = [c for c in ready.columns if c != label and c not in keep]
    scaled = fit_scale(ready, "maxabs", feats)
    return train(df, feats, label, "gradient_boosting", preparation=FittedFeatures([*prep.steps, scaled]), **params)


# ----------------------------------------------------------------- forecasting


def series_features(
    df: DataFrame, series: str, time: str, value: str, period: str = "day", lags: Sequence[int] = (1, 7), windows: Sequence[int] = (7,)
) -> DataFrame:
    """Value per series and period, with lags and trailing means.

    Rows are summed per period first, so a series is as long as the calendar, not as its
    rows: a hot series costs one window group of that many periods. A lag looks up the
    period itself, so a missing period gives null.
    """
    if period not in ("hour", "day"):
        raise ValueError(f"unknown period {period!r}; use hour or day")
    day = quoted(time).cast("date")
    index, at = F.unix_date(day), day.cast("timestamp_ntz")
    if period == "hour":
        index = index * 24 + F.hour(quoted(time))
        at = at + F.make_dt_interval(hours=F.hour(quoted(time)))
    stamped = df.select(
        quoted(series).alias(series), index.alias("_i"), at.alias("period"), quoted(value).cast("double").alias("_y")
    )
    indexed = stamped.groupBy(series, "_i", "period").agg(F.sum("_y").alias("y"))
    order = Window.partitionBy(series).orderBy("_i")
    return indexed.select(
        quoted(series),
        "period",
        "y",
        *[F.max("y").over(order.rangeBetween(-k, -k)).alias(f"lag_{k}") for k in lags],
        *[F.avg("y").over(order.rangeBetween(-w, -1)).alias(f"mean_{w}") for w in windows],
    )


def split_by_time(df: DataFrame, time: str, horizon: str = "7 days") -> DataFrame:
    """Add ``split``: the last ``horizon`` of the whole table is the test part."""
    last = df.agg(F.max(quoted(time))).first()[0]
    cut = typed_lit(last, T.TimestampNTZType()) - F.expr(f"INTERVAL {horizon}")
    return df.withColumn("split", F.when(quoted(time) > cut, F.lit("test")).otherwise(F.lit("train")))


def forecast(
    df: DataFrame, series: str, time: str, value: str, period: str = "day", horizon: str = "7 days", kind: str = "gradient_boosting", **params
) -> tuple[Trained, DataFrame]:
    """The model fitted on all but the last ``horizon``, and (series, period, y, prediction) of that part, forecast step by step."""
    from tabweave.operators import forecasting as S

    n = S.periods_in(horizon, period)
    cutoff = (df.agg(F.max(S.period_index(quoted(time), period))).first()[0] or 0) - n
    fitted = S.fit_forecaster(df, series, time, value, period, kind, cutoff=cutoff, **params)
    truth = series_features(df, series, time, value, period, (1,), ()).select(quoted(series), "period", "y")
    said = fitted.ahead(df, n, cutoff).join(truth, [series, "period"])
    return fitted.model, said.select(quoted(series), "period", "y", "prediction")
