import numpy as np
import pytest
from pyspark.sql import functions as F

from tabweave.operators import boosting as B
from tabweave.operators import models as G


def _three(spark, n=600):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(n, 2)), 1)
    y = np.where(x[:, 0] > 0.5, 2, np.where(x[:, 1] > 0, 1, 0))
    y = np.where(rng.random(n) < 0.1, rng.integers(0, 3, n), y)
    table = [(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))]
    return spark.createDataFrame(table, "id int, a double, b double, y double").repartition(3), x, y


def _plain_rounds(x, y, k, rounds, depth, step):
    """The same boosting with every value a threshold, by loops over rows and splits."""
    margins = np.tile(np.log(np.bincount(y, minlength=k) / len(y)), (len(y), 1))
    for _ in range(rounds):
        p = B.softmax(margins)
        for c in range(k):
            r = (y == c) - p[:, c]

            def grow(rows, left):
                best = (1e-12, None)
                for f in range(x.shape[1]) if left else ():
                    for v in np.unique(x[rows, f])[:-1]:
                        low = x[rows, f] <= v
                        gain = r[rows][low].sum() ** 2 / low.sum() + r[rows][~low].sum() ** 2 / (~low).sum() - r[rows].sum() ** 2 / len(rows)
                        if gain > best[0] + 1e-9:
                            best = (gain, low)
                if best[1] is None:
                    a = np.abs(r[rows])
                    margins[rows, c] += step * (k - 1) / k * r[rows].sum() / (a * (1 - a)).sum()
                    return
                grow(rows[best[1]], left - 1)
                grow(rows[~best[1]], left - 1)

            grow(np.arange(len(y)), depth)
    return B.softmax(margins)


@pytest.mark.parametrize("here", [B.CELLS_HERE, 0])
def test_joint_boosting_equals_plain_loops(spark, monkeypatch, here):
    monkeypatch.setattr(B, "CELLS_HERE", here)
    df, x, y = _three(spark, 250)
    t = G.train(df, ["a", "b"], "y", "gradient_boosting", maxIter=3, maxDepth=2, maxBins=256)
    got = t.score(df, ["id"]).orderBy("id").toPandas()
    want = _plain_rounds(x, y, 3, 3, 2, 0.1)
    assert np.allclose(got[["p0", "p1", "p2"]], want)
    assert (got["prediction"] == want.argmax(axis=1)).all()


def test_loss_falls_and_starts_at_the_entropy(spark, monkeypatch):
    monkeypatch.setattr(B, "ROUNDS_PER_WRITE", 2)
    df, x, y = _three(spark)
    t = G.train(df, ["a", "b"], "y", "gradient_boosting", maxIter=5, maxDepth=2)
    losses = t.model.stages[-1].losses_by_round()
    share = np.bincount(y) / len(y)
    assert losses[0] == pytest.approx(-(share * np.log(share)).sum())
    assert all(b < a for a, b in zip(losses, losses[1:])) and len(losses) == 5
    p = F.element_at(F.array("p0", "p1", "p2"), F.col("y").cast("int") + 1)
    assert t.score(df, ["y"]).agg(F.avg(-F.log(p))).first()[0] < losses[-1]


def test_saved_and_read_again(spark, tmp_path):
    df, _, _ = _three(spark, 90)
    t = G.train(df, ["a", "b"], "y", "gradient_boosting", maxIter=2, maxDepth=1)
    G.save_trained(t, str(tmp_path / "m"), df)
    again = G.load_trained(spark, str(tmp_path / "m"))
    assert again.score(df, ["id"]).orderBy("id").collect() == t.score(df, ["id"]).orderBy("id").collect()


def test_constant_features_absent_classes_and_bad_labels(frame):
    df = frame([(1.0, 0.0), (1.0, 2.0), (1.0, 2.0)], "a double, y double")
    t = G.train(df, ["a"], "y", "gradient_boosting", maxIter=2)
    row = t.score(df, []).first()
    assert row["prediction"] == 2.0 and row["p1"] < 1e-6
    with pytest.raises(ValueError):
        G.train(frame([(1.0, None), (1.0, 2.0)], "a double, y double"), ["a"], "y", "gradient_boosting")
    with pytest.raises(ValueError):
        B.SoftmaxBoost(maxBins=1)


def test_rounds_work_on_cells_of_equal_rows(spark, monkeypatch):
    seen = []
    plain = B.SoftmaxBoost._round
    monkeypatch.setattr(B.SoftmaxBoost, "_round", lambda self, rows, *a: seen.append(rows.count()) or plain(self, rows, *a))
    df, x, y = _three(spark, 250)
    many = df.crossJoin(spark.range(8).select(F.col("id").alias("again")))
    t = G.train(many, ["a", "b"], "y", "gradient_boosting", maxIter=3, maxDepth=2, maxBins=256)
    assert np.allclose(t.score(df, ["id"]).orderBy("id").toPandas()[["p0", "p1", "p2"]], _plain_rounds(x, y, 3, 3, 2, 0.1))
    assert max(seen) <= 250
