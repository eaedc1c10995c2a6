"""Forecasts of many series, several periods ahead, and their judgement on rolling cut-offs.

One model serves all series. It learns the next value from the values before it; ahead of a cut-off it is asked for one period
after the other, and what it says becomes the newest value of its series for the next. Rows after a cut-off are removed before
any feature is made, so none of them can reach a forecast. A series is a row with its newest values while it is forecast, so the
table stays as long as the number of series; each period is written to the shared folder, which ends its lineage.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.functions.columns import quoted
from tabweave.operators.features import FittedFeatures
from tabweave.operators.models import FillStep, Trained, series_features, train
from tabweave.operators.quality import impute_values
from tabweave.session import written

LAGS, WINDOWS = (1, 7), (7,)


def period_index(time: Column, period: str) -> Column:
    """Number of the period a time lies in, counted from 1970."""
    if period not in ("hour", "day"):
        raise ValueError(f"unknown period {period!r}; use hour or day")
    day = F.unix_date(time.cast("date")).cast("bigint")
    return day if period == "day" else day * 24 + F.hour(time)


def period_start(index: Column, period: str) -> Column:
    """The time a period begins at."""
    day = index if period == "day" else F.floor(index / 24)
    at = F.date_from_unix_date(day.cast("int")).cast("timestamp_ntz")
    return at if period == "day" else at + F.make_dt_interval(hours=F.pmod(index, F.lit(24)).cast("int"))


def periods_in(horizon: int | str, period: str) -> int:
    """A horizon as a number of periods: a number, or text such as ``7 days``."""
    if isinstance(horizon, int):
        n = horizon
    else:
        count, unit = horizon.split()
        scale = {("day", "day"): 1, ("hour", "hour"): 1, ("day", "hour"): 24, ("week", "day"): 7, ("week", "hour"): 168}.get((unit.rstrip("s"), period))
        if scale is None:
            raise ValueError(f"the horizon {horizon!r} is no number of periods of a {period}")
        n = int(count) * scale
    if n < 1:
        raise ValueError("the horizon must be a period at least")
    return n


def calendar_parts(df: DataFrame, period: str) -> tuple[DataFrame, list[str]]:
    """Month, weekday and, for hours, the hour of the column ``period``."""
    parts = {"month": F.month("period"), "weekday": F.weekday("period")} | ({"hour": F.hour("period")} if period == "hour" else {})
    return df.withColumns(parts), list(parts)


@dataclass
class Forecaster:
    """A model of the next value, and what it needs to go on from any history."""

    model: Trained
    series: str
    time: str
    value: str
    period: str
    lags: tuple[int, ...]
    windows: tuple[int, ...]

    def ahead(self, history: DataFrame, horizon: int | str, cutoff: int | None = None) -> DataFrame:
        """(series, step, period, prediction) for each of the next periods after ``cutoff``, by default the last of the table.

        Every series of the history up to the cut-off is forecast, also one without newer rows. A series without any value
        that a feature asks for takes the training medians.
        """
        n, width = periods_in(horizon, self.period), max(*self.lags, *self.windows, 1)
        index = period_index(quoted(self.time), self.period)
        rows = history.select(quoted(self.series).alias(self.series), index.alias("_i"), quoted(self.value).cast("double").alias("_y")).where("_i IS NOT NULL")
        if cutoff is None:
            cutoff = rows.agg(F.max("_i")).first()[0]
        if cutoff is None:
            return rows.select(quoted(self.series), F.lit(0).alias("step"), F.lit(None).cast("timestamp_ntz").alias("period"), F.col("_y").alias("prediction"))
        sums = rows.where(F.col("_i") <= cutoff).groupBy(self.series, "_i").agg(F.sum("_y").alias("_y"))
        recent = F.collect_list(F.when(F.col("_i") > cutoff - width, F.struct("_i", "_y")))
        # The newest values, oldest first; a period without rows is null.
        values = F.map_from_entries(recent)
        state = sums.groupBy(self.series).agg(values.alias("_seen"))
        tail = F.transform(F.sequence(F.lit(cutoff - width + 1), F.lit(cutoff)), lambda i: F.try_element_at("_seen", i))
        state = written(state.select(quoted(self.series), tail.alias("_tail")), "series-tails")
        steps = []
        for step in range(1, n + 1):
            at = period_start(F.lit(cutoff + step).cast("bigint"), self.period)
            lags = {f"lag_{k}": F.element_at("_tail", -k) for k in self.lags}
            means = {f"mean_{w}": _mean(F.filter(F.slice("_tail", -w, w), lambda v: v.isNotNull())) for w in self.windows}
            asked, _ = calendar_parts(state.select(quoted(self.series), "_tail").withColumns({"period": at, **lags, **means}), self.period)
            said = self.model.score(asked, [self.series, "period", "_tail"])
            newer = F.slice(F.concat("_tail", F.array("prediction")), 2, width)
            state = written(said.select(quoted(self.series), F.lit(step).alias("step"), "period", "prediction", newer.alias("_tail")), "forecast-step")
            steps.append(state.drop("_tail"))
        return reduce(DataFrame.unionByName, steps)


def _mean(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda s, v: s + v) / F.size(values))


def fit_forecaster(
    df: DataFrame,
    series: str,
    time: str,
    value: str,
    period: str = "day",
    kind: str = "gradient_boosting",
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    cutoff: int | None = None,
    **params: Any,
) -> Forecaster:
    """Fit a model of the next value on the rows up to the period ``cutoff`` (by default all).

    Values of a series are summed per period; gaps are filled with the training medians. Features that no training row has
    are left out.
    """
    past = df if cutoff is None else df.where(period_index(quoted(time), period) <= cutoff)
    made, parts = calendar_parts(series_features(past, series, time, value, period, lags, windows), period)
    lagged = [*[f"lag_{k}" for k in lags], *[f"mean_{w}" for w in windows]]
    made = written(made, "series-features")
    fill = FillStep({c: v for c, v in impute_values(made, lagged).items() if v is not None})
    feats = [*[c for c in lagged if c in fill.values], *parts]
    model = train(made, feats, "y", kind, "regression", preparation=FittedFeatures([fill]), **params)
    return Forecaster(model, series, time, value, period, tuple(lags), tuple(windows))


def rolling(
    df: DataFrame, series: str, time: str, value: str, period: str = "day", horizon: int | str = "7 days", folds: int = 3, **how: Any
) -> DataFrame:
    """(fold, series, step, period, y, prediction) of forecasts from ``folds`` cut-offs, each a horizon before the next.

    Fold 1 ends at the last period of the table. Each fold has a model of its own, fitted on what lies before its cut-off.
    Periods of a series without rows have no row here. A table too short for a fold leaves that fold out.
    """
    n = periods_in(horizon, period)
    index = period_index(quoted(time), period)
    first, last = df.agg(F.min(index), F.max(index)).first()
    truth = df.groupBy(quoted(series).alias(series), index.alias("_i")).agg(F.sum(quoted(value).cast("double")).alias("y"))
    truth = truth.select(quoted(series), period_start(F.col("_i"), period).alias("period"), "y")
    parts = []
    for fold in range(1, folds + 1):
        cutoff = (last or 0) - n * fold
        if first is None or cutoff <= first:
            break
        said = fit_forecaster(df, series, time, value, period, cutoff=cutoff, **how).ahead(df, n, cutoff)
        parts.append(said.withColumn("fold", F.lit(fold)))
    if not parts:
        raise ValueError("the table has too few periods for one horizon and a period before it")
    said = reduce(DataFrame.unionByName, parts)
    return said.join(truth, [series, "period"]).select("fold", quoted(series), "step", "period", "y", "prediction")
