"""Queries over samples, splits and folds."""

from __future__ import annotations

from tabweave.catalog.base import LINE_KEY, big, hash_sql, longs, query, scored_lines, table
from tabweave.operators import split as S

_OH = hash_sql("o_orderkey")
_LH = hash_sql(*LINE_KEY)
_LINE_ORDER = f"{_LH}, l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")


@query(f"SELECT o_orderkey, o_orderstatus, CASE WHEN {_OH} % 100 < 20 THEN 'test' ELSE 'train' END AS split FROM orders")
def split_bucket(spark, sf):
    return S.split_by_bucket(_orders(spark, sf), ["o_orderkey"], 20)


@query(
    f"""SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (ORDER BY {_OH}, o_orderkey)
        <= (SELECT ceil(count(*) * 0.2) FROM orders) THEN 'test' ELSE 'train' END AS split FROM orders"""
)
def split_random(spark, sf):
    return S.split_random(_orders(spark, sf), ["o_orderkey"], 0.2)


_QUOTAS = """c AS (SELECT {0} AS cls, count(*) AS n FROM {1} GROUP BY 1),
  q AS (SELECT cls, n, sum(n) OVER () AS t, sum(n) OVER () - ceil(sum(n) OVER () * 0.2) AS want FROM c),
  f AS (SELECT *, floor(round(n * want / t, 9)) AS low, round(n * want / t - floor(round(n * want / t, 9)), 9) AS part FROM q),
  g AS (SELECT *, want - sum(low) OVER () AS spare, row_number() OVER (ORDER BY part DESC, cls) AS place FROM f),
  quota AS (SELECT cls, n - low - CASE WHEN place <= spare THEN 1 ELSE 0 END AS k FROM g)"""


@query(
    f"""WITH {_QUOTAS.format("o_orderstatus", "orders")}
        SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_OH}, o_orderkey) <= k
        THEN 'test' ELSE 'train' END AS split FROM orders JOIN quota ON o_orderstatus = cls"""
)
def split_stratified(spark, sf):
    return S.split_stratified(_orders(spark, sf), ["o_orderkey"], "o_orderstatus", 0.2)


@query(
    f"""WITH s AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderstatus) - 1 AS p,
          row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_OH}, o_orderkey) AS r FROM orders),
        sizes AS (SELECT o_orderstatus AS cls, p % 5 AS fold, count(*) AS n FROM s GROUP BY ALL),
        ends AS (SELECT cls, fold, sum(n) OVER (PARTITION BY cls ORDER BY fold) AS hi,
          sum(n) OVER (PARTITION BY cls ORDER BY fold) - n AS lo FROM sizes)
        SELECT o_orderkey, o_orderstatus, fold::bigint AS fold FROM s JOIN ends ON o_orderstatus = cls AND r > lo AND r <= hi"""
)
def stratified_folds(spark, sf):
    return longs(S.stratified_folds(_orders(spark, sf), ["o_orderkey"], "o_orderstatus", 5), "fold")


@query(
    f"""WITH s AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY {_OH}, o_orderkey) - 1 AS r,
          count(*) OVER () AS n FROM orders)
        SELECT o_orderkey, o_orderstatus, CASE WHEN r < (n % 5) * (n // 5 + 1) THEN r // (n // 5 + 1)
          ELSE (n % 5) + (r - (n % 5) * (n // 5 + 1)) // (n // 5) END AS fold FROM s"""
)
def plain_folds(spark, sf):
    return longs(S.plain_folds(_orders(spark, sf), ["o_orderkey"], 5), "fold")


@query(f"SELECT o_orderkey, o_orderstatus FROM orders ORDER BY {_OH}, o_orderkey LIMIT 100")
def sample_n(spark, sf):
    return S.sample_n(_orders(spark, sf), ["o_orderkey"], 100)


@query(
    f"""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem),
        t AS (SELECT least(500, count(*)) AS total, sum(label) AS p, sum(1 - label) AS n FROM l),
        k AS (SELECT least(p, total // 4) AS kp, least(n, total - least(p, total // 4)) AS kn FROM t),
        o AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_LINE_ORDER}) AS r FROM l)
        SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, l_partkey, l_suppkey, label::bigint AS label FROM o, k
        WHERE r <= CASE WHEN label = 1 THEN kp ELSE kn END"""
)
def quota_sample(spark, sf):
    rows = scored_lines(spark, sf).select(*LINE_KEY, "label")
    return longs(S.quota_sample(rows, LINE_KEY, "label", 500), "l_linenumber", "label")


@query(
    """SELECT * FROM (SELECT quality::bigint AS wanted, doc_id FROM labels WHERE quality = 1 ORDER BY doc_id LIMIT 1)
       UNION ALL SELECT * FROM (SELECT quality::bigint AS wanted, doc_id FROM labels WHERE quality = 0 ORDER BY doc_id LIMIT 1)"""
)
def first_of_class(spark, sf):
    rows = table(spark, sf, "labels").select("doc_id", "quality")
    return S.first_of_each_class(rows, "quality", ["doc_id"]).select(big("wanted").alias("wanted"), "doc_id")
