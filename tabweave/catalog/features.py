"""Queries over feature steps."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tabweave.catalog.base import GAPPY_SQL, LABELLED_SQL, gappy_events, hash_sql, labelled_documents, longs, query, r6, rounded, table
from tabweave.config import Bin, DateParts, Derived, FeatureConfig, ValidationConfig
from tabweave.functions.columns import bin_code, hash_key
from tabweave.operators import features as X
from tabweave.operators.encode import fit_first_seen_codes, fit_sorted_codes, fit_target_means, out_of_fold_means
from tabweave.operators.models import auto_features, fit_dialect, series_features, split_by_time
from tabweave.plans.flow import prepare

_SIZE_CASE = """CASE WHEN p_size > 0 AND p_size <= 10 THEN {0} WHEN p_size > 10 AND p_size <= 20 THEN {1}
  WHEN p_size > 20 AND p_size <= 30 THEN {2} WHEN p_size > 30 AND p_size <= 50 THEN {3} END"""


def _parts(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_size")


@query(
    f"""SELECT p_partkey, p_size::bigint AS p_size, {_SIZE_CASE.format("'S'", "'M'", "'L'", "'XL'")} AS size_group,
        ({_SIZE_CASE.format(0, 1, 2, 3)})::bigint AS size_code FROM part"""
)
def bin_edges(spark, sf):
    step = X.fit_bin(_parts(spark, sf), Bin("p_size", [0, 10, 20, 30, 50], ["S", "M", "L", "XL"], "size_group"))
    out = step.transform(_parts(spark, sf)).withColumn("size_code", bin_code(F.col("p_size"), step.edges))
    return longs(out, "p_size", "size_code")


@query(
    """WITH m AS (SELECT min(p_size)::double AS lo, max(p_size)::double AS hi FROM part),
       e AS (SELECT lo - (hi-lo)*0.001 AS e0, lo+(hi-lo)/4*1 AS e1, lo+(hi-lo)/4*2 AS e2, lo+(hi-lo)/4*3 AS e3, hi FROM m)
       SELECT p_partkey, p_size::bigint AS p_size, CASE WHEN p_size > e0 AND p_size <= e1 THEN 'q1'
         WHEN p_size > e1 AND p_size <= e2 THEN 'q2' WHEN p_size > e2 AND p_size <= e3 THEN 'q3'
         WHEN p_size > e3 AND p_size <= hi THEN 'q4' END AS p_size_binned FROM part, e"""
)
def bin_width(spark, sf):
    rows = _parts(spark, sf)
    return longs(X.fit_bin(rows, Bin("p_size", 4, ["q1", "q2", "q3", "q4"])).transform(rows), "p_size")


@query(
    f"""SELECT p_partkey, p_size::bigint AS p_size,
        {_SIZE_CASE.format("'(0, 10]'", "'(10, 20]'", "'(20, 30]'", "'(30, 50]'")} AS p_size_binned FROM part"""
)
def bin_interval_labels(spark, sf):
    rows = _parts(spark, sf)
    return longs(X.fit_bin(rows, Bin("p_size", [0, 10, 20, 30, 50])).transform(rows), "p_size")


@query(
    """SELECT event_id, year(ts) AS ts_year, month(ts) AS ts_month, day(ts) AS ts_day, isodow(ts) - 1 AS ts_dayofweek,
       quarter(ts) AS ts_quarter, hour(ts) AS ts_hour FROM events"""
)
def date_parts(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts")
    every = DateParts("ts", ("year", "month", "day", "dayofweek", "quarter", "hour"))
    out = X.fit_dates(rows, every).transform(rows).drop("ts")
    return longs(out, *out.columns)


@query(
    """SELECT o_orderkey, o_orderdate AS d, year(o_orderdate) AS d_year, isodow(o_orderdate) - 1 AS d_dayofweek FROM orders"""
)
def date_parse_text(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("d"))
    return longs(X.fit_dates(rows, DateParts("d", ("year", "dayofweek"))).transform(rows), "d_year", "d_dayofweek")


def _scaled(spark, sf, method):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", F.lit(7.0).alias("constant")
    )
    names = ["l_quantity", "l_extendedprice", "l_discount", "constant"]
    return rounded(X.fit_scale(rows, method, names).transform(rows), *names)


def _scale_sql(centre: str, spread: str) -> str:
    cols = ("l_quantity", "l_extendedprice", "l_discount")
    stats = ", ".join(f"{centre.format(c)} AS c_{c}, {spread.format(c)} AS s_{c}" for c in cols)
    shown = ", ".join(f"round(({c} - c_{c}) / s_{c}, 6) + 0.0 AS {c}" for c in cols)
    constant = "1.0::double" if centre == "0.0" else "0.0::double"
    return f"SELECT l_orderkey, l_partkey, {shown}, {constant} AS constant FROM lineitem, (SELECT {stats} FROM lineitem)"


@query(_scale_sql("avg({0})", "stddev_pop({0})"))
def scale_standard(spark, sf):
    return _scaled(spark, sf, "standard")


@query(_scale_sql("min({0})", "(max({0}) - min({0}))"))
def scale_minmax(spark, sf):
    return _scaled(spark, sf, "minmax")


@query(_scale_sql("median({0})", "(quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25))"))
def scale_robust(spark, sf):
    return _scaled(spark, sf, "robust")


@query(_scale_sql("0.0", "max(abs({0}))"))
def scale_maxabs(spark, sf):
    return _scaled(spark, sf, "maxabs")


_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query(
    "SELECT o_orderkey, "
    + ", ".join(f"(o_orderpriority = '{p}')::bigint AS \"o_orderpriority_{p}\"" for p in _PRIORITIES[1:])
    + " FROM orders"
)
def onehot_drop_first(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    out = X.fit_onehot(rows, ["o_orderpriority"]).transform(rows)
    return longs(out, *out.columns)


@query(
    f"""WITH {GAPPY_SQL} SELECT event_id, coalesce(event_type = 'error', false)::bigint AS event_type_error,
        coalesce(event_type = 'purchase', false)::bigint AS event_type_purchase,
        coalesce(event_type = 'view', false)::bigint AS event_type_view FROM gappy"""
)
def onehot_with_missing(spark, sf):
    rows = gappy_events(spark, sf).select("event_id", "event_type")
    out = X.fit_onehot(rows, ["event_type"]).transform(rows)
    return longs(out, *out.columns)


@query(
    f"""WITH {GAPPY_SQL}, codes AS (SELECT event_type AS t, dense_rank() OVER (ORDER BY event_type) - 1 AS code
          FROM (SELECT DISTINCT event_type FROM gappy WHERE event_type IS NOT NULL))
        SELECT event_id, coalesce(code, -1)::bigint AS event_type FROM gappy LEFT JOIN codes ON event_type = t"""
)
def label_codes(spark, sf):
    rows = gappy_events(spark, sf).select("event_id", "event_type")
    return longs(fit_sorted_codes(rows, ["event_type"])["event_type"].apply(rows), "event_type")


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::bigint AS l_linenumber,
       dense_rank() OVER (ORDER BY l_orderkey) - 1 AS order_code FROM lineitem"""
)
def label_codes_many(spark, sf):
    """A column with too many values for the driver: codes by key range, kept as a table."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    coder = fit_sorted_codes(rows, ["l_orderkey"], driver_keys=1000, one_task_keys=1000)["l_orderkey"]
    return longs(coder.apply(rows, "order_code"), "order_code", "l_linenumber")


@query(
    f"""WITH {GAPPY_SQL}, filled AS (SELECT event_id, coalesce(event_type, 'UNKNOWN') AS t FROM gappy)
        SELECT event_id, (dense_rank() OVER (ORDER BY t) - 1)::bigint AS event_type FROM filled"""
)
def label_encode_text(spark, sf):
    rows = gappy_events(spark, sf).select("event_id", "event_type")
    coder = fit_sorted_codes(rows, ["event_type"], fill="UNKNOWN")["event_type"]
    return longs(coder.apply(rows), "event_type")


@query(
    f"""WITH {GAPPY_SQL}, codes AS (SELECT t, row_number() OVER (ORDER BY f) - 1 AS code FROM
          (SELECT event_type AS t, min(event_id) AS f FROM gappy WHERE event_type IS NOT NULL GROUP BY 1))
        SELECT event_id, coalesce(code, -1)::bigint AS event_type FROM gappy LEFT JOIN codes ON event_type = t"""
)
def factorize(spark, sf):
    rows = gappy_events(spark, sf).select("event_id", "event_type")
    coder = fit_first_seen_codes(rows, ["event_type"], "event_id")["event_type"]
    return longs(coder.apply(rows), "event_type")


@query(
    f"""WITH {GAPPY_SQL}, means AS (SELECT event_type AS t, avg(user_id) AS m FROM gappy GROUP BY 1)
        SELECT event_id, round(coalesce(m, (SELECT avg(user_id) FROM gappy)), 6) AS event_type
        FROM gappy LEFT JOIN means ON event_type = t"""
)
def target_encode(spark, sf):
    rows = gappy_events(spark, sf).select("event_id", "user_id", "event_type")
    coder = fit_target_means(rows, ["event_type"], "user_id")["event_type"]
    return rounded(coder.apply(rows).drop("user_id"), "event_type")


@query(
    f"""WITH {GAPPY_SQL}, f AS (SELECT *, {hash_sql("event_id")} % 5 AS fold FROM gappy),
        prior AS (SELECT a.fold, (SELECT avg(b.user_id) FROM f b WHERE b.fold <> a.fold) AS p FROM (SELECT DISTINCT fold FROM f) a),
        part AS (SELECT event_type, fold, sum(user_id) AS s, count(*) AS n FROM f WHERE event_type IS NOT NULL GROUP BY ALL),
        rest AS (SELECT event_type, fold, sum(s) OVER w - s AS s, sum(n) OVER w - n AS n FROM part WINDOW w AS (PARTITION BY event_type))
        SELECT event_id, round(coalesce((s + 20 * p) / (n + 20), p), 6)::double AS event_type_te
        FROM f JOIN prior USING (fold) LEFT JOIN rest USING (event_type, fold)"""
)
def target_encode_folds(spark, sf):
    """Means over the other four folds, smoothed by 20 rows of their mean."""
    rows = gappy_events(spark, sf).select("event_id", "user_id", "event_type")
    fold = hash_key([F.col("event_id")]) % 5
    out = out_of_fold_means(rows, ["event_type"], "user_id", fold, smoothing=20.0)
    return rounded(out.select("event_id", "event_type_te"), "event_type_te")


_LINE = ["l_orderkey", "l_partkey", "l_quantity", "l_discount"]


@query(
    """SELECT l_orderkey, l_partkey, l_quantity, l_discount,
       round(l_quantity * l_discount, 6) AS l_quantity_x_l_discount FROM lineitem"""
)
def interaction(spark, sf):
    rows = table(spark, sf, "lineitem").select(*_LINE)
    out = X.InteractionStep([["l_quantity", "l_discount"]]).transform(rows)
    return rounded(out, "l_quantity_x_l_discount")


@query(
    """SELECT l_orderkey, l_partkey, l_quantity, l_discount, round(pow(l_quantity, 2), 6) AS l_quantity_power_2,
       round(pow(l_quantity, 3), 6) AS l_quantity_power_3 FROM lineitem"""
)
def polynomial(spark, sf):
    out = X.PowerStep(["l_quantity"], 3).transform(table(spark, sf, "lineitem").select(*_LINE))
    return rounded(out, "l_quantity_power_2", "l_quantity_power_3")


_CUSTOM = {
    "enabled": True,
    "custom": {
        "enabled": True,
        "transformations": [
            {"name": "ratio", "expression": "l_extendedprice / (l_quantity + 1)"},
            {"name": "gap", "expression": "l_tax - l_discount"},
            {"name": "gap_squared", "expression": "pow(gap, 2)"},
        ],
    },
}


@query(
    """SELECT l_orderkey, l_partkey, round(l_extendedprice / (l_quantity + 1), 8) AS ratio,
       round(l_tax - l_discount, 6) + 0.0 AS gap, round(pow(l_tax - l_discount, 2), 6) AS gap_squared
       FROM lineitem"""
)
def custom_expr(spark, sf):
    rows = table(spark, sf, "lineitem")
    out = X.fit_features(rows, FeatureConfig.from_dict(_CUSTOM)).transform(rows)
    return out.select(
        "l_orderkey", "l_partkey", F.round("ratio", 8).alias("ratio"), r6("gap").alias("gap"), r6("gap_squared").alias("gap_squared")
    )


@query(
    """SELECT l_orderkey, l_partkey, round(l_extendedprice * (1 - l_discount), 6) AS net FROM lineitem"""
)
def custom_registered_function(spark, sf):
    """An expression that calls a vectorised Python function registered by name."""

    @F.pandas_udf("double")
    def net_price(price: pd.Series, discount: pd.Series) -> pd.Series:
        return price * (1 - discount)

    spark.udf.register("net_price", net_price)
    rows = table(spark, sf, "lineitem")
    cfg = FeatureConfig(derived=(Derived("net", "net_price(l_extendedprice, l_discount)"),), on_error="raise")
    out = X.fit_features(rows, cfg).transform(rows)
    return rounded(out.select("l_orderkey", "l_partkey", "net"), "net")


_FLOW = {
    "enabled": True,
    "binning": {
        "enabled": True,
        "features": [
            {"column": "o_totalprice", "bins": [0, 100000, 250000, 1000000], "labels": ["low", "mid", "high"], "new_column": "price_group"}
        ],
    },
    "datetime_features": {"enabled": True, "columns": [{"column": "o_orderdate", "extract": ["year", "month", "dayofweek"]}]},
    "custom": {"enabled": True, "transformations": [{"name": "per_customer", "expression": "o_totalprice / (o_custkey + 1)"}]},
    "scaling": {"enabled": True, "method": "standard", "columns": ["o_totalprice", "per_customer"]},
    "encoding": {"enabled": True, "method": "onehot", "columns": ["o_orderpriority", "price_group"]},
    "interactions": {"enabled": True, "feature_pairs": [["o_totalprice", "o_orderdate_dayofweek"]]},
    "polynomial": {"enabled": True, "degree": 2, "columns": ["o_totalprice"]},
}

FLOW_SQL = """WITH a AS (SELECT *, o_totalprice / (o_custkey + 1) AS per_customer FROM orders),
  s AS (SELECT avg(o_totalprice) AS m1, stddev_pop(o_totalprice) AS s1, avg(per_customer) AS m2, stddev_pop(per_customer) AS s2 FROM a),
  z AS (SELECT o_orderkey, o_custkey, o_orderstatus, (o_totalprice - m1) / s1 AS p, o_orderdate, o_orderpriority, o_totalprice,
          year(o_orderdate) AS y, month(o_orderdate) AS mo, isodow(o_orderdate) - 1 AS dw, (per_customer - m2) / s2 AS pc FROM a, s)
  SELECT o_orderkey, o_custkey, o_orderstatus, round(p, 6) + 0.0 AS o_totalprice, o_orderdate, y AS o_orderdate_year, mo AS o_orderdate_month,
    dw AS o_orderdate_dayofweek, round(pc, 6) + 0.0 AS per_customer,
    (o_orderpriority = '2-HIGH')::bigint AS "o_orderpriority_2-HIGH", (o_orderpriority = '3-MEDIUM')::bigint AS "o_orderpriority_3-MEDIUM",
    (o_orderpriority = '4-NOT SPECIFIED')::bigint AS "o_orderpriority_4-NOT SPECIFIED", (o_orderpriority = '5-LOW')::bigint AS "o_orderpriority_5-LOW",
    (o_totalprice > 100000 AND o_totalprice <= 250000)::bigint AS price_group_mid,
    (o_totalprice > 250000 AND o_totalprice <= 1000000)::bigint AS price_group_high,
    round(p * dw, 6) + 0.0 AS o_totalprice_x_o_orderdate_dayofweek, round(pow(p, 2), 6) + 0.0 AS o_totalprice_power_2 FROM z"""

_FLOW_DOUBLES = ["o_totalprice", "per_customer", "o_totalprice_x_o_orderdate_dayofweek", "o_totalprice_power_2"]


def flow_features(spark, sf):
    """The feature flow on orders, fitted on all rows, and its fitted steps."""
    rows = table(spark, sf, "orders")
    return prepare(rows, None, None, FeatureConfig.from_dict(_FLOW))


@query(FLOW_SQL)
def feature_flow(spark, sf):
    out, _ = flow_features(spark, sf)
    whole = [c for c in out.columns if c not in _FLOW_DOUBLES and c not in ("o_orderstatus", "o_orderdate")]
    return longs(rounded(out, *_FLOW_DOUBLES), *whole)


@query(
    f"""WITH {LABELLED_SQL}, d AS (SELECT DISTINCT text, lang, source, n_chars FROM labelled),
        s AS (SELECT min(n_chars) AS lo, max(n_chars) - min(n_chars) AS w FROM d)
        SELECT text, (dense_rank() OVER (ORDER BY lang) - 1)::bigint AS lang, round((n_chars - lo) / w, 6) AS n_chars,
          CASE WHEN n_chars > 0 AND n_chars <= 500 THEN 'short' WHEN n_chars > 500 AND n_chars <= 5000 THEN 'medium'
               WHEN n_chars > 5000 AND n_chars <= 1000000 THEN 'long' END AS length_group FROM d, s"""
)
def prepare_flow(spark, sf):
    """Validate (drops quality and toxic, then duplicates), drop a column, build features."""
    cfg = FeatureConfig(
        bins=(Bin("n_chars", [0, 500, 5000, 1000000], ["short", "medium", "long"], "length_group"),),
        scale_method="minmax",
        scale_columns=("n_chars",),
        encode_method="label",
        encode_columns=("lang",),
    )
    rows = labelled_documents(spark, sf).drop("doc_id")
    out, _ = prepare(rows, ValidationConfig(), ["source"], cfg)
    return longs(rounded(out, "n_chars"), "lang")


@query(
    """SELECT o_orderkey, o_custkey::double AS o_custkey, o_totalprice, (o_orderstatus = 'O')::double AS "o_orderstatus_O",
       (o_orderstatus = 'P')::double AS "o_orderstatus_P", year(o_orderdate)::double AS o_orderdate_year, month(o_orderdate)::double AS o_orderdate_month,
       day(o_orderdate)::double AS o_orderdate_day, (isodow(o_orderdate) - 1)::double AS o_orderdate_dayofweek,
       quarter(o_orderdate)::double AS o_orderdate_quarter, hour(o_orderdate)::double AS o_orderdate_hour, """
    + ", ".join(f"(o_orderpriority = '{p}')::double AS \"o_orderpriority_{p}\"" for p in _PRIORITIES[1:])
    + " FROM orders"
)
def auto_featurize(spark, sf):
    rows = table(spark, sf, "orders")
    return auto_features(rows, "o_orderkey").transform(rows)


def _dialect_rows(spark, sf):
    e = gappy_events(spark, sf)
    return e.withColumn("is_heavy", F.col("user_id") > 100)


_DIALECT_SQL = f"""WITH {GAPPY_SQL}, f AS (SELECT *, coalesce(event_type, '{{0}}') AS t FROM gappy)
  SELECT event_id::double AS event_id, user_id, coalesce(value, {{1}})::double AS value,
    (dense_rank() OVER (ORDER BY t) - 1)::double AS event_type, (user_id > 100)::bigint::double AS is_heavy FROM f"""


@query(_DIALECT_SQL.format("MISSING", "(SELECT median(value) FROM gappy)"))
def dialect_missing_median(spark, sf):
    rows = _dialect_rows(spark, sf)
    return fit_dialect(rows, "a", "user_id").transform(rows)


@query(_DIALECT_SQL.format("UNKNOWN", "(SELECT median(value) FROM gappy)"))
def dialect_unknown_median(spark, sf):
    rows = _dialect_rows(spark, sf)
    return fit_dialect(rows, "b", "user_id").transform(rows)


@query(_DIALECT_SQL.format("nan", "NULL"))
def dialect_text_cast(spark, sf):
    rows = _dialect_rows(spark, sf)
    return fit_dialect(rows, "c", "user_id").transform(rows)


@query(
    f"""WITH {GAPPY_SQL}, codes AS (SELECT t, row_number() OVER (ORDER BY f) - 1 AS code FROM
          (SELECT event_type AS t, min(event_id) AS f FROM gappy WHERE event_type IS NOT NULL GROUP BY 1))
        SELECT event_id::double AS event_id, user_id, coalesce(value, 0)::double AS value, coalesce(code, -1)::double AS event_type,
          (user_id > 100)::bigint::double AS is_heavy FROM gappy LEFT JOIN codes ON event_type = t"""
)
def dialect_first_seen(spark, sf):
    rows = _dialect_rows(spark, sf)
    return fit_dialect(rows, "d", "user_id", order_by="event_id").transform(rows)


@query(_DIALECT_SQL.format("UNKNOWN", "0"))
def dialect_zero_fill(spark, sf):
    rows = _dialect_rows(spark, sf).withColumn("RACE_LABEL", F.lit("x"))
    return fit_dialect(rows, "e", "user_id").transform(rows)


@query(
    """WITH d AS (SELECT event_type, date_trunc('day', ts)::timestamp AS period, sum(value) AS y FROM events GROUP BY ALL)
       SELECT event_type, period, round(y, 6) AS y,
         round((SELECT max(y) FROM d b WHERE b.event_type = d.event_type AND b.period = d.period - INTERVAL 1 DAY), 6) AS lag_1,
         round((SELECT max(y) FROM d b WHERE b.event_type = d.event_type AND b.period = d.period - INTERVAL 7 DAY), 6) AS lag_7,
         round((SELECT avg(y) FROM d b WHERE b.event_type = d.event_type AND b.period < d.period AND b.period >= d.period - INTERVAL 7 DAY), 6) AS mean_7,
         CASE WHEN period > (SELECT max(period) FROM d) - INTERVAL 7 DAY THEN 'test' ELSE 'train' END AS split FROM d"""
)
def series_lags(spark, sf):
    made = series_features(table(spark, sf, "events"), "event_type", "ts", "value")
    return rounded(split_by_time(made, "period", "7 days"), "y", "lag_1", "lag_7", "mean_7")
