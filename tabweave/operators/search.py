"""Model search: candidates, folds or a validation part, a leaderboard, the best model."""

from __future__ import annotations

import math
import random
import threading
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabweave.config import SearchConfig
from tabweave.functions.columns import hash_key, quoted
from tabweave.operators import metrics as M
from tabweave.operators.models import Trained, out_of_fold, split_by_time, train
from tabweave.operators.split import plain_folds, split_random, split_stratified, stratified_folds
from tabweave.session import written

# Metric names a config may use, with the name used here.
METRIC_NAMES = {
    "accuracy": "accuracy",
    "auc_weighted": "auc_weighted",
    "AUC_weighted": "auc_weighted",
    "precision_score_weighted": "precision_weighted",
    "recall_score_weighted": "recall_weighted",
    "f1_score_weighted": "f1_weighted",
    "precision_score_macro": "precision_macro",
    "recall_score_macro": "recall_macro",
    "f1_score_macro": "f1_macro",
    "r2_score": "r2",
    "rmse": "rmse",
    "root_mean_squared_error": "rmse",
    "normalized_root_mean_squared_error": "rmse_normalised",
    "mean_absolute_error": "mae",
    "normalized_mean_absolute_error": "mae_normalised",
    "spearman_correlation": "spearman",
}
SMALLER_IS_BETTER = {"rmse", "rmse_normalised", "mae", "mae_normalised"}
PATIENCE = 3


@dataclass(frozen=True)
class Candidate:
    name: str
    kind: str
    params: Mapping[str, Any]


@dataclass
class SearchResult:
    """``members``: the best models, refitted on all rows, if the config asks for a vote of them."""

    leaderboard: DataFrame
    best: Candidate
    model: Trained
    members: list[Trained] = field(default_factory=list)


def default_candidates(task: str) -> list[Candidate]:
    last = "logistic_regression" if task == "classification" else "linear_regression"
    return [Candidate(k, k, {}) for k in ("random_forest", "gradient_boosting", last)]


def choose(candidates: Sequence[Candidate], cfg: SearchConfig) -> list[Candidate]:
    """Candidates that are allowed (an empty list allows all) and not blocked."""
    kept = [c for c in candidates if (not cfg.allowed or c.name in cfg.allowed) and c.name not in cfg.blocked]
    return kept[: cfg.max_trials] if cfg.max_trials else kept


class Cancelled(Exception):
    """A trial that took longer than it may."""


def within(spark: SparkSession, seconds: float | None, work: Callable[[], Any]) -> Any:
    """The result of ``work``, whose Spark jobs are cancelled once it takes longer; then ``Cancelled`` is raised.

    The jobs carry a tag of this call, so that those of other threads go on. What runs between two jobs is not stopped, but
    no further job gets through.
    """
    if seconds is None:
        return work()
    context = spark.sparkContext
    tag, over, done = f"trial-{uuid.uuid4().hex}", threading.Event(), threading.Event()

    def watch() -> None:
        if done.wait(max(0.0, seconds)):
            return
        over.set()
        while not done.wait(0.5):
            context.cancelJobsWithTag(tag)

    context.addJobTag(tag)
    context.setInterruptOnCancel(True)
    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        found = work()
    except Exception as e:
        if over.is_set():
            raise Cancelled(f"cancelled after {seconds:.0f} s") from e
        raise
    finally:
        done.set()
        watcher.join()
        context.removeJobTag(tag)
    if over.is_set():
        raise Cancelled(f"cancelled after {seconds:.0f} s")
    return found


def evaluate(scored: DataFrame, label: str, task: str) -> dict[str, float]:
    """All metrics of one set of predictions; several passes, so the caller writes them first."""
    if task == "classification":
        classes = [c for c in scored.columns if c[:1] == "p" and c[1:].isdigit()]
        out = M.accuracy(scored, label, "prediction").first().asDict()
        out |= M.prf_averaged(scored, label, "prediction").first().asDict()
        if classes:
            out |= M.auc_weighted(scored, label, {int(c[1:]): c for c in classes}).first().asDict()
        return out
    out = M.regression_metrics(scored, label, "prediction").first().asDict()
    return out | M.spearman(scored, label, "prediction").first().asDict()


def search(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    label: str,
    cfg: SearchConfig,
    candidates: Sequence[Candidate] | None = None,
    time_column: str | None = None,
    horizon: str = "7 days",
    split: str | None = None,
    judge: Callable[[DataFrame, Candidate], DataFrame] | None = None,
) -> SearchResult:
    """Judge every candidate on rows it was not trained on, then refit the best on all rows.

    Folds win over a validation part if both are set. After the time limit, or without
    progress over PATIENCE candidates under early stopping, no further candidate starts. The jobs of a
    candidate that takes longer than a trial may, or than the whole search has left once there is a
    result, are cancelled; the leaderboard has it with the status ``cancelled`` and no value.
    Forecasting is regression judged on the last ``horizon`` of ``time_column``. ``split`` names a
    column that says ``train`` or ``test`` already; ``judge`` gives a candidate's scores of rows it has not seen by a way of its
    own. With ``vote_members`` the mean of that many best
    candidates is judged too, on the scores they have; it needs keys that identify a row.
    """
    if cfg.primary_metric not in METRIC_NAMES:
        raise ValueError(f"unknown metric {cfg.primary_metric!r}")
    metric = METRIC_NAMES[cfg.primary_metric]
    task = "regression" if cfg.task == "forecasting" else cfg.task
    todo = choose(candidates or default_candidates(task), cfg)
    if not todo:
        raise ValueError("no candidate is allowed")
    if judge is not None:
        marked = df
    elif cfg.task == "forecasting":
        if time_column is None:
            raise ValueError("forecasting needs the time column")
        marked, judge = split_by_time(df, time_column, horizon), _on_held_out(keys, features, label, task)
    elif split is not None:
        marked, judge = df.withColumnRenamed(split, "split"), _on_held_out(keys, features, label, task)
    else:
        marked, judge = _judge(df, keys, features, label, cfg)
    # All candidates are judged on these rows; making them is no part of the first one's trial.
    marked = written(marked, "marked")
    deadline = time.monotonic() + 60 * cfg.timeout_minutes if cfg.timeout_minutes else None
    better = (lambda a, b: a < b) if metric in SMALLER_IS_BETTER else (lambda a, b: a > b)
    results: list[tuple[Candidate, dict[str, float], float]] = []
    cut_off: list[tuple[Candidate, float]] = []
    scores: dict[str, DataFrame] = {}
    best: float | None = None
    stale = 0
    with ThreadPoolExecutor(max(1, cfg.parallel_trials)) as pool:
        for i in range(0, len(todo), max(1, cfg.parallel_trials)):
            if results and deadline is not None and time.monotonic() >= deadline:
                break
            if cfg.early_stopping and stale >= PATIENCE:
                break
            batch = todo[i : i + max(1, cfg.parallel_trials)]

            limits = [60 * cfg.trial_timeout_minutes] if cfg.trial_timeout_minutes else []
            if results and deadline is not None:
                limits.append(deadline - time.monotonic())

            def trial(c: Candidate):
                start = time.monotonic()

                def work() -> dict[str, float]:
                    scores[c.name] = written(judge(marked, c), "scores")
                    return evaluate(scores[c.name], label, task)

                try:
                    return c, within(df.sparkSession, min(limits, default=None), work), time.monotonic() - start
                except Cancelled:
                    return c, None, time.monotonic() - start

            for c, found, took in pool.map(trial, batch):
                if found is None:
                    cut_off.append((c, took))
                    continue
                results.append((c, found, took))
                value = found[metric]
                if best is None or better(value, best):
                    best, stale = value, 0
                else:
                    stale += 1
    if not results:
        raise TimeoutError("no candidate ended within the limit of a trial")
    ranked = sorted(results, key=lambda r: r[1][metric] * (1 if metric in SMALLER_IS_BETTER else -1))
    winner, chosen = ranked[0], ranked[: cfg.vote_members]
    if len(chosen) > 1:
        start = time.monotonic()
        found = evaluate(written(mean_scores([scores[c.name] for c, _, _ in chosen], keys, label, task), "scores"), label, task)
        results.append((Candidate("voting_ensemble", "vote", {}), found, time.monotonic() - start))
    rows = [(c.name, c.kind, m, float(v), took, "done") for c, found, took in results for m, v in found.items() if v is not None]
    rows += [(c.name, c.kind, metric, None, took, "cancelled") for c, took in cut_off]
    board = df.sparkSession.createDataFrame(
        rows, "model string, kind string, metric string, value double, seconds double, status string"
    )
    rest = marked.select(*[quoted(c) for c in df.columns if c != split])
    members = [train(rest, features, label, c.kind, task, keep=False, **c.params) for c, _, _ in chosen] if len(chosen) > 1 else []
    model = members[0] if members else train(rest, features, label, winner[0].kind, task, keep=False, **winner[0].params)
    return SearchResult(board, winner[0], model, members)


# What parameter samples of each kind of model are drawn from; a pair is a range on a logarithmic scale.
SPACES: dict[str, dict[str, Any]] = {
    "random_forest": {"numTrees": [10, 20, 50, 100], "maxDepth": [3, 5, 8, 10], "minInstancesPerNode": [1, 2, 5, 20]},
    "gradient_boosting": {"maxIter": [10, 20, 50, 100], "maxDepth": [2, 3, 5], "stepSize": (0.02, 0.5)},
    "logistic_regression": {"C": (1e-4, 1e2)},
    "linear_regression": {"regParam": (1e-6, 1e1)},
}


def sample_candidates(n: int, kinds: Sequence[str], seed: int = 42, spaces: Mapping[str, Mapping[str, Any]] = SPACES) -> list[Candidate]:
    """n candidates, kinds in turn, their parameters drawn from the spaces of their kinds; the same for the same seed."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind = kinds[i % len(kinds)]
        drawn = {}
        for name, values in spaces[kind].items():
            if isinstance(values, tuple):
                drawn[name] = math.exp(rng.uniform(math.log(values[0]), math.log(values[1])))
            else:
                drawn[name] = rng.choice(values)
        out.append(Candidate(f"{kind}_{i}", kind, drawn))
    return out


#: Steps in which shares of rows are told apart; the hash of a row is below its share on every rung that has it.
SHARE_STEPS = 1 << 20


def on_rung(keys: Sequence[str], share: float, seed: int = 42) -> Column:
    """Whether a row belongs to a rung of this share: rungs are nested, a row of a smaller one is in every larger one."""
    return F.pmod(hash_key([quoted(k) for k in keys], seed), F.lit(SHARE_STEPS)) < F.lit(math.ceil(share * SHARE_STEPS))


@dataclass
class HalvingResult:
    """``rungs``: a row per candidate and rung with its share, rows, value, status and whether it went on."""

    rungs: DataFrame
    best: Candidate
    model: Trained


def successive_halving(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    label: str,
    cfg: SearchConfig,
    candidates: Sequence[Candidate],
    rungs: int = 3,
    keep: int = 3,
    seed: int = 42,
) -> HalvingResult:
    """Judge many candidates on a small share of the rows, the best of them on ``keep`` times more, and so on to all rows.

    A quarter of the rows (``cfg.validation_size``), chosen by hash, is held out; every rung trains and judges on its share
    of both parts. Of each rung the best 1/``keep`` go on, one at least; ties go by name. Limits of a trial hold for each
    rung; a candidate that is cancelled does not go on. The winner of the last rung is refitted on all rows.
    """
    metric, task = METRIC_NAMES[cfg.primary_metric], cfg.task
    left = choose(candidates, cfg)
    if not left or rungs < 1 or keep < 2:
        raise ValueError("give a candidate, a rung at least, and keep one of two or more")
    sign = 1 if metric in SMALLER_IS_BETTER else -1
    held = on_rung(keys, cfg.validation_size or 0.25, seed + 1)
    table = written(df.select(*dict.fromkeys([*keys, *features, label]), held.alias("_held")), "halving")
    rows: list[tuple] = []
    limit = 60 * cfg.trial_timeout_minutes if cfg.trial_timeout_minutes else None
    for rung in range(rungs):
        share = float(keep) ** (rung + 1 - rungs)
        part = written(table.where(on_rung(keys, share, seed)), "rung")
        sizes = dict(part.groupBy("_held").count().collect())
        train_rows, test_rows = part.where("NOT _held").drop("_held"), part.where("_held").drop("_held")

        def trial(c: Candidate) -> float | None:
            def work() -> float | None:
                t = train(train_rows, features, label, c.kind, task, **c.params)
                return evaluate(written(t.score(test_rows, [*keys, label]), "scores"), label, task).get(metric)

            try:
                return within(df.sparkSession, limit, work)
            except Cancelled:
                return None

        with ThreadPoolExecutor(max(1, cfg.parallel_trials)) as pool:
            found = list(zip(left, pool.map(trial, left)))
        good = sorted((v * sign, c.name) for c, v in found if v is not None)
        if not good:
            raise TimeoutError("no candidate ended within the limit of a trial")
        going = {name for _, name in good[: max(1, len(left) // keep)]}
        rows += [
            (rung, c.name, c.kind, share, sizes.get(False, 0), sizes.get(True, 0), v, "done" if v is not None else "cancelled", c.name in going) for c, v in found
        ]
        best = good[0][1]
        left = [c for c in left if c.name in going]
    winner = next(c for c in left if c.name == best)
    board = df.sparkSession.createDataFrame(
        rows, "rung int, model string, kind string, share double, n_train long, n_test long, value double, status string, went_on boolean"
    )
    return HalvingResult(board, winner, train(df, features, label, winner.kind, task, **winner.params))


def mean_scores(scored: Sequence[DataFrame], keys: Sequence[str], label: str, task: str) -> DataFrame:
    """The mean of several models' scores of the same rows, and what it predicts."""
    names = [c for c in scored[0].columns if c[:1] == "p" and c[1:].isdigit()] if task == "classification" else ["prediction"]
    parts = [s.select(*[quoted(k) for k in keys], quoted(label), *names) for s in scored]
    whole = reduce(DataFrame.unionByName, parts).groupBy(*[quoted(k) for k in keys]).agg(
        F.first(quoted(label)).alias(label), *[F.avg(n).alias(n) for n in names]
    )
    if task != "classification":
        return whole
    each = F.array(*names)
    return whole.withColumn("prediction", (F.array_position(each, F.array_max(each)) - 1).cast("double"))


def _judge(df, keys, features, label, cfg):
    if cfg.folds:
        fold = stratified_folds(df, keys, label, cfg.folds) if cfg.task == "classification" else plain_folds(df, keys, cfg.folds)

        def by_folds(rows: DataFrame, c: Candidate) -> DataFrame:
            return out_of_fold(rows, keys, features, label, c.kind, cfg.task, "fold", cfg.folds, keep=False, **c.params)

        return fold, by_folds
    size = cfg.validation_size or 0.2
    if cfg.task == "classification":
        parts = split_stratified(df, keys, label, size)
    else:
        parts = split_random(df, keys, size)

    return parts, _on_held_out(keys, features, label, cfg.task)


def _on_held_out(keys, features, label, task):
    def judge(rows: DataFrame, c: Candidate) -> DataFrame:
        t = train(rows.where("split = 'train'"), features, label, c.kind, task, keep=False, **c.params)
        return t.score(rows.where("split = 'test'"), [*keys, label])

    return judge


def ranking(board: DataFrame, metric: str) -> DataFrame:
    """Candidates ordered by one metric, best first, cancelled ones last (one row per candidate)."""
    name = METRIC_NAMES.get(metric, metric)
    value = F.col("value").asc_nulls_last() if name in SMALLER_IS_BETTER else F.col("value").desc_nulls_last()
    return board.where(quoted("metric") == name).orderBy(value, "model")
