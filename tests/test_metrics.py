import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabweave.operators import cohorts as C
from tabweave.operators import metrics as M
from tabweave.plans import lookup as L
from tabweave.plans import ordered as O


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 700)
    s = np.round(rng.normal(size=700) + y * 0.7, 2)
    s[:250] = 0.5  # a third of the rows share one score
    g = rng.integers(0, 3, 700)
    pdf = pd.DataFrame({"y": y, "s": s, "p": (s > 0.4).astype(int), "g": g})
    return pdf, spark.createDataFrame(pdf).repartition(5).cache()


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return (np.sum(pos[:, None] > neg[None, :]) + 0.5 * np.sum(pos[:, None] == neg[None, :])) / (len(pos) * len(neg))


@pytest.mark.parametrize("one_task", [20, 1_000_000])
def test_auc(scored, monkeypatch, one_task):
    monkeypatch.setattr(O, "ONE_TASK_KEYS", one_task)
    pdf, df = scored
    assert M.roc_auc(df, "y", "s").first()["auc"] == pytest.approx(brute_auc(pdf["y"].to_numpy(), pdf["s"].to_numpy()))
    for r in M.roc_auc(df, "y", "s", ["g"]).collect():
        part = pdf[pdf["g"] == r["g"]]
        assert r["auc"] == pytest.approx(brute_auc(part["y"].to_numpy(), part["s"].to_numpy()))
    assert M.roc_auc(df.where("y = 1"), "y", "s").first()["auc"] is None


def test_auc_weighted(scored):
    pdf, df = scored
    a = M.auc_weighted(df.withColumn("t", -F.col("s")), "y", {0: "t", 1: "s"}).first()[0]
    assert a == pytest.approx(brute_auc(pdf["y"].to_numpy(), pdf["s"].to_numpy()))


@pytest.mark.parametrize("one_task,broadcast", [(20, 10), (1_000_000, 1_000_000)])
def test_spearman(scored, monkeypatch, one_task, broadcast):
    monkeypatch.setattr(O, "ONE_TASK_KEYS", one_task)
    monkeypatch.setattr(L, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(L, "HOT_SHARE", 10)
    pdf, df = scored
    got = M.spearman(df.withColumn("x", F.col("s") * F.col("s") + F.col("g")), "x", "s").first()
    want = (pdf["s"] ** 2 + pdf["g"]).rank().corr(pdf["s"].rank())
    assert got["n"] == 700 and got["spearman"] == pytest.approx(want)


def test_classification_numbers(scored):
    pdf, df = scored
    y, p = pdf["y"], pdf["p"]
    tp, fp, fn = ((y == 1) & (p == 1)).sum(), ((y == 0) & (p == 1)).sum(), ((y == 1) & (p == 0)).sum()
    got = M.prf_binary(df, "y", "p").first()
    assert tuple(got) == pytest.approx((tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn)))
    report = {r["name"]: r for r in M.classification_report(df, "y", "p").collect()}
    assert report["1"]["recall"] == pytest.approx(tp / (tp + fn))
    assert report["accuracy"]["f1"] == pytest.approx((y == p).mean())
    assert report["macro avg"]["precision"] == pytest.approx((report["0"]["precision"] + report["1"]["precision"]) / 2)
    assert report["weighted avg"]["support"] == 700
    assert M.confusion(df, "y", "p").agg(F.sum("n")).first()[0] == 700


def test_zero_division(frame):
    df = frame([(0, 0), (0, 0)], "y int, p int")
    assert tuple(M.prf_binary(df, "y", "p").first()) == (0.0, 0.0, 0.0)


def test_regression_numbers(frame):
    df = frame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "y double, p double")
    got = M.regression_metrics(df, "y", "p").first()
    y, p = np.array([1, 2, 4.0]), np.array([1.5, 2, 3])
    assert got["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert got["rmse_normalised"] == pytest.approx(np.sqrt(((y - p) ** 2).mean()) / 3)
    assert got["mae"] == pytest.approx(0.5)


def test_cross_validation_summary(frame):
    df = frame([(0, 1, 1), (0, 1, 0), (1, 1, 1), (1, 0, 0)], "fold int, y int, p int")
    assert tuple(M.cv_summary(df, "y", "p", "fold").first()) == (2, 0.75, 0.5)


def test_cohorts(scored):
    pdf, df = scored
    df = df.withColumn("big", F.col("s") > 0.5)
    cube = C.error_cube(df, F.col("y") != F.col("p"), ["g", "big"]).toPandas()
    assert len(cube) == (3 + 1) * (2 + 1)
    total = cube[cube["level"] == 0].iloc[0]
    assert total["n"] == 700 and total["coverage"] == 1.0 and total["errors"] == (pdf["y"] != pdf["p"]).sum()
    by = C.cohort_metrics(df, "g", "y", "p", "s")
    gaps = {r["metric"]: r["gap"] for r in C.fairness_gaps(by).collect()}
    acc = pdf.assign(h=pdf["y"] == pdf["p"]).groupby("g")["h"].mean()
    assert gaps["accuracy"] == pytest.approx(acc.max() - acc.min())
    cal = C.calibration(df.withColumn("q", F.col("p") * 1.0), "y", "q", 4).toPandas()
    assert sorted(cal["bucket"]) == [0, 3]
    both = C.gather({"a": by.select("g", "n"), "b": cal_frame(df)})
    assert set(both.columns) == {"insight", "g", "n", "z"}
    tree = C.error_tree(df, F.col("y") != F.col("p"), ["s"], 2).toPandas()
    assert tree["row_share"].sum() == pytest.approx(1.0)


def cal_frame(df):
    return df.limit(1).select(F.lit(1).alias("z"))
