import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabweave.config import Bin, DateParts, Derived, FeatureConfig
from tabweave.operators import encode as N
from tabweave.operators import features as X
from tabweave.plans import lookup as L


def rows(df, *by):
    return [tuple(r) for r in df.orderBy(*by).collect()]


def test_onehot_edges(frame):
    df = frame([(1, "b", 3), (2, None, 1), (3, "a", 3)], "id int, k string, n int")
    out = X.fit_onehot(df, ["k", "n"]).transform(df)
    assert out.columns == ["id", "k_b", "n_3"]
    assert rows(out, "id") == [(1, 1, 1), (2, 0, 0), (3, 0, 1)]


def test_onehot_keeps_unseen_bins_in_bin_order(frame):
    df = frame([(1, 15.0), (2, 15.0), (3, None)], "id int, v double")
    cfg = FeatureConfig(bins=(Bin("v", [0, 10, 20, 30], ["l", "m", "n"], "g"),), encode_columns=("g",))
    out = X.fit_features(df, cfg).transform(df)
    assert out.columns == ["id", "v", "g_m", "g_n"]
    assert [r[2:] for r in rows(out, "id")] == [(1, 0), (1, 0), (0, 0)]


def test_onehot_matches_pandas(frame):
    data = [(i, "abc"[i % 3] if i % 7 else None, i % 4) for i in range(40)]
    df = frame(data, "id int, k string, n int")
    want = pd.get_dummies(pd.DataFrame(data, columns=["id", "k", "n"]), columns=["k", "n"], drop_first=True).astype(int)
    got = X.fit_onehot(df, ["k", "n"]).transform(df).orderBy("id").toPandas()
    assert list(got.columns) == list(want.columns)
    assert (got.to_numpy() == want.to_numpy()).all()


@pytest.mark.parametrize("n", [9_999, 10_001])
def test_onehot_has_a_category_for_every_value(spark, n):
    df = spark.range(n).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("k"))
    assert X.fit_onehot(df, ["k"]).categories["k"] == [f"{i:06d}" for i in range(n)]


def test_codes_are_bigint_in_every_form(spark):
    df = spark.range(40).select(F.col("id").cast("string").alias("k"), "id")
    for driver_keys in (40, 39):
        sorted_, first = N.fit_sorted_codes(df, ["k"], driver_keys=driver_keys)["k"], N.fit_first_seen_codes(df, ["k"], "id", driver_keys)["k"]
        assert {dict(c.apply(df).dtypes)["k"] for c in (sorted_, first)} == {"bigint"}


@pytest.mark.parametrize("n", [19, 20, 21, 39, 41])
def test_few_values_are_counted_exactly(spark, n):
    df = spark.range(300).select((F.col("id") % n).cast("string").alias("k"), F.lit(None).cast("string").alias("none"))
    assert N.columns_up_to(df, ["k", "none"], 20) == (["k", "none"] if n <= 20 else ["none"])


def test_quotient_by_zero_is_null(frame):
    df = frame([(1.0, 0.0), (4.0, 2.0)], "a double, b double")
    for on_error in ("skip", "raise"):
        cfg = FeatureConfig(derived=(Derived("q", "a / b"),), on_error=on_error)
        assert sorted(r["q"] or 0 for r in X.fit_features(df, cfg).transform(df).collect()) == [0, 2.0]


def test_dates_in_several_formats(frame):
    df = frame([("01/15/2023",), ("2023-01-16",), ("2023-01-17 10:00:00",), (None,)], "d string")
    got = X.fit_dates(df, DateParts("d", ("day", "hour"))).transform(df)
    assert sorted((r["d_day"], r["d_hour"]) for r in got.where("d IS NOT NULL").collect()) == [(15, 0), (16, 0), (17, 10)]
    with pytest.raises(ValueError):
        X.fit_dates(df, DateParts("d", ("day",), ()))


def test_bin_code_column_from_a_config(frame):
    df = frame([(5,), (15,), (99,)], "v int")
    step = X.fit_bin(df, Bin("v", [0, 10, 20], ["a", "b"], "g", "g_code"))
    assert sorted((r["v"], r["g"], r["g_code"]) for r in step.transform(df).collect()) == [(5, "a", 0), (15, "b", 1), (99, None, None)]


def test_codes(frame):
    df = frame([(1, "b"), (2, None), (3, "a")], "id int, k string")
    assert [r[1] for r in rows(N.fit_sorted_codes(df, ["k"])["k"].apply(df), "id")] == [1, -1, 0]
    assert [r[1] for r in rows(N.fit_first_seen_codes(df, ["k"], "id")["k"].apply(df), "id")] == [0, -1, 1]
    filled = N.fit_sorted_codes(df, ["k"], fill="UNKNOWN")["k"]
    assert [r[1] for r in rows(filled.apply(df), "id")] == [2, 0, 1]


def test_unseen_value_gets_the_default(frame):
    train = frame([("a",), ("b",)], "k string")
    new = frame([("a",), ("z",)], "k string")
    assert sorted(r[0] for r in N.fit_sorted_codes(train, ["k"])["k"].apply(new).collect()) == [-1, 0]


@pytest.mark.parametrize("case_keys,driver_keys", [(64, 1000), (0, 1000), (0, 3)])
def test_every_dictionary_form_gives_the_same_codes(spark, monkeypatch, case_keys, driver_keys):
    """CASE, broadcast join and the table with hot keys; a third of the rows share one key."""
    monkeypatch.setattr(N, "CASE_KEYS", case_keys)
    monkeypatch.setattr(L, "BROADCAST_BYTES", 200)
    monkeypatch.setattr(L, "HOT_SHARE", 20)
    key = F.when(F.col("id") % 3 == 0, F.lit("k7")).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))
    )
    df = spark.range(900).select("id", key.alias("k"), F.col("id").cast("double").alias("y"))
    pdf = df.toPandas().sort_values("id")
    coder = N.fit_sorted_codes(df, ["k"], driver_keys=driver_keys, one_task_keys=10)["k"]
    assert (coder.table is not None) == (driver_keys == 3)
    got = coder.apply(df, "c").toPandas().sort_values("id")
    assert list(got["c"]) == list(pdf["k"].astype("category").cat.codes)
    first = N.fit_first_seen_codes(df, ["k"], "id", driver_keys=driver_keys)["k"]
    got = first.apply(df, "c").toPandas().sort_values("id")
    assert list(got["c"]) == list(pd.factorize(pdf["k"])[0])
    mean = N.fit_target_means(df, ["k"], "y", driver_keys=driver_keys)["k"]
    got = mean.apply(df, "m").toPandas().sort_values("id")
    want = pdf.groupby("k")["y"].transform("mean").fillna(pdf["y"].mean())
    assert list(got["m"]) == pytest.approx(list(want))
    again = N.Dictionary.from_dict(coder.to_dict())
    assert again.apply(df, "c").agg(F.sum("c")).first()[0] == coder.apply(df, "c").agg(F.sum("c")).first()[0]


def test_scaling(frame):
    df = frame([(1.0, 4.0, None), (2.0, 4.0, 3.0), (6.0, 4.0, float("nan")), (None, 4.0, 5.0)], "a double, c double, b double")
    a = pd.Series([1.0, 2.0, 6.0])
    out = X.fit_scale(df, "standard", ["a", "c", "b"])
    assert out.stats["a"] == pytest.approx([a.mean(), a.std(ddof=0)])
    assert out.stats["b"] == pytest.approx([4.0, 1.0])
    assert {r[1] for r in out.transform(df).collect()} == {0.0}
    assert X.fit_scale(df, "minmax", ["a"]).stats["a"] == [1.0, 5.0]
    assert X.fit_scale(df, "robust", ["a"]).stats["a"] == pytest.approx([2.0, a.quantile(0.75) - a.quantile(0.25)])
    assert X.fit_scale(df, "maxabs", ["a"]).stats["a"] == [0.0, 6.0]
    for method in X.SCALE_METHODS:
        assert {r[0] for r in X.fit_scale(df, method, ["c"]).transform(df).select("c").collect()} <= {0.0, 1.0}
    with pytest.raises(ValueError):
        X.fit_scale(frame([("x",)], "t string"), "standard", ["t"])


def test_dates_are_strict(frame):
    good = frame([("2024-01-01",), (None,)], "d string")
    out = X.fit_dates(good, DateParts("d", ("dayofweek", "year", "nonsense"))).transform(good)
    assert out.columns == ["d", "d_year", "d_dayofweek"]
    bad = frame([("2024-01-01",), ("zz",)], "d string")
    with pytest.raises(ValueError):
        X.fit_dates(bad, DateParts("d", ("year",)))
    skipped = X.fit_features(bad, FeatureConfig(dates=(DateParts("d", ("year",)),)))
    assert skipped.transform(bad).columns == ["d"]


def test_error_policy(frame):
    df = frame([(1.0, "x")], "a double, t string")
    cfg = dict(bins=(Bin("a", [3, 1]), Bin("none", [0, 1])), derived=(Derived("z", "no_column"), Derived("ok", "a + 1")))
    assert X.fit_features(df, FeatureConfig(**cfg)).transform(df).columns == ["a", "t", "ok"]
    with pytest.raises(ValueError):
        X.fit_features(df, FeatureConfig(**cfg, on_error="raise"))
    with pytest.raises(TypeError):
        X.fit_features(df, FeatureConfig(interactions=(("a", "t"),)))


def test_stage_order_and_case_sensitivity(frame):
    df = frame([(1, 1.0), (2, 3.0)], "id int, A double")
    cfg = FeatureConfig.from_dict(
        {
            "scaling": {"enabled": True, "columns": ["A", "a"]},
            "custom": {"enabled": True, "transformations": [{"name": "B", "expression": "A * 10"}, {"name": "C", "expression": "B + 1"}]},
            "interactions": {"enabled": True, "feature_pairs": [["A", "B"], ["A"], ["A", "nope"]]},
            "polynomial": {"enabled": True, "degree": 3, "columns": ["A"]},
            "binning": {"enabled": False, "features": [{"column": "A", "bins": [0, 1], "labels": ["x"]}]},
        }
    )
    out = X.fit_features(df, cfg).transform(df)
    assert out.columns == ["id", "A", "B", "C", "A_x_B", "A_power_2", "A_power_3"]
    assert rows(out, "id") == [(1, -1.0, 10.0, 11.0, -10.0, 1.0, -1.0), (2, 1.0, 30.0, 31.0, 30.0, 1.0, 1.0)]


def test_fit_on_train_apply_to_all_and_save(frame):
    df = frame([(1, 0.0, "a"), (2, 2.0, "b"), (3, 100.0, "c")], "id int, v double, k string")
    cfg = FeatureConfig(
        bins=(Bin("v", 2),), dates=(), scale_columns=("v",), encode_columns=("k",), encode_method="label", derived=(Derived("w", "v * 2"),)
    )
    fitted = X.fit_features(df.where("id < 3"), cfg)
    again = X.FittedFeatures.from_json(fitted.to_json())
    got = rows(again.transform(df), "id")
    assert got == rows(fitted.transform(df), "id")
    assert got[2][1:3] == (99.0, -1)
    assert X.fit_features(df, FeatureConfig(enabled=False)).transform(df).columns == df.columns


def test_callable_expression(frame):
    df = frame([(1.0,)], "a double")
    fitted = X.fit_features(df, FeatureConfig(derived=(Derived("b", lambda d: d["a"] + 1),)))
    assert fitted.transform(df).first()["b"] == 2.0
    with pytest.raises(ValueError):
        fitted.to_json()


def test_own_step(frame):
    from dataclasses import dataclass

    @dataclass
    class LengthStep(X.FeatureStep):
        column: str

        def transform(self, df):
            return df.withColumn(f"{self.column}_length", F.length(self.column))

    X.STEPS["LengthStep"] = LengthStep
    df = frame([("abc",)], "t string")
    again = X.FittedFeatures.from_json(X.FittedFeatures([LengthStep("t")]).to_json())
    assert again.transform(df).first()["t_length"] == 3


def test_dates_as_categories_ignore_the_session_time_zone(frame, spark):
    df = frame([("2024-03-31 02:30:00",), ("2024-03-31 03:30:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        out = X.fit_onehot(df, ["t"]).transform(df)
        assert sorted(r[0] for r in out.collect()) == [0, 1]
        coded = N.fit_sorted_codes(df, ["t"])["t"].apply(df, "c")
        assert [r["c"] for r in coded.orderBy("t").collect()] == [0, 1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _plain_folds(rows, m):
    """Target means of (category, fold, label) rows over the other folds, by loops."""
    out = []
    for c, f, _ in rows:
        rest = [(k, y) for k, g, y in rows if g != f and y is not None]
        mean = sum(y for _, y in rest) / len(rest) if rest else None
        own = [y for k, y in rest if k == c and c is not None]
        out.append((sum(own) + m * mean) / (len(own) + m) if own else mean)
    return out


@pytest.mark.parametrize("m", [0.0, 3.0])
@pytest.mark.parametrize("broadcast", [True, False])
def test_out_of_fold_means_equal_loops(frame, monkeypatch, m, broadcast):
    from tabweave.plans import lookup

    if not broadcast:
        monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    rows = [("a", 0, 1.0), ("a", 1, 3.0), ("a", 1, None), ("b", 0, 5.0), (None, 2, 7.0), ("a", 2, 2.0), ("", 1, 4.0), ("", 2, 4.5)]
    df = frame([(i, *r, float(len(r[0] or ""))) for i, r in enumerate(rows)], "id int, k string, f int, y double, d double")
    out = N.out_of_fold_means(df, ["k", "d"], "y", F.col("f"), m)
    assert out.columns == [*df.columns, "k_te", "d_te"]
    got = out.orderBy("id").collect()
    assert [r["k_te"] for r in got] == pytest.approx(_plain_folds(rows, m))
    assert [r["d_te"] for r in got] == pytest.approx(_plain_folds([(float(len(k or "")), f, y) for k, f, y in rows], m))


def test_out_of_fold_means_of_noise_stay_noise(spark):
    df = spark.range(4000).select("id", (F.xxhash64("id") % 800).alias("k"), (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(2))).cast("double").alias("y"))
    folds = N.out_of_fold_means(df, ["k"], "y", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)))
    plain = N.fit_target_means(df, ["k"], "y")["k"].apply(df, "k_in")
    assert abs(folds.agg(F.corr("k_te", "y")).first()[0]) < 0.1
    assert plain.agg(F.corr("k_in", "y")).first()[0] > 0.3


def test_out_of_fold_means_of_odd_tables(frame):
    schema = "k string, f int, y double"
    assert N.out_of_fold_means(frame([], schema), ["k"], "y", F.col("f")).count() == 0
    one = N.out_of_fold_means(frame([("a", 0, 1.0), ("a", 0, 2.0)], schema), ["k"], "y", F.col("f"))
    assert [r["k_te"] for r in one.collect()] == [None, None]
    nulls = N.out_of_fold_means(frame([(None, 0, 1.0), (None, 1, 3.0)], schema), ["k"], "y", F.col("f"))
    assert sorted(r["k_te"] for r in nulls.collect()) == [1.0, 3.0]
    with pytest.raises(ValueError):
        N.out_of_fold_means(frame([("a", 0, 1.0, 0.0)], schema + ", k_te double"), ["k"], "y", F.col("f"))
