"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sizes are words. Targets share a total by weight; no target is above `most` times its source's size, what is cut off is
shared again. The total is cut into blocks of equal size, which go to the sources by highest quotients target / (2k + 1).
Each source is dealt into shards of a bounded number of documents by a keyed hash of the document; the blocks of a source
go to its shards by highest quotients of their sizes. In a shard, documents stand in the order of a keyed hash and their
words are cut into blocks; the quota takes every block as often as it divides evenly, and the remainder as a run of blocks
that starts at a seeded place and goes round. A document takes what its words have in those blocks.

Sums come from one aggregation by (source, shard); the driver gets one row per source. Texts are never shuffled: one
shuffle of (document, size) by shard, whose sizes are bounded however large a source is.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """Weights repeat over the sources in order of their names (code points, null last)."""

    weights: tuple[int, ...] = (5, 2, 1)
    most: int = 3
    block: int = 64
    shard_rows: int = 2_000
    seed: str = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: Sequence[int], weights: Sequence[int], most: int) -> list[Fraction]:
    """Shares of the sum of the sizes by weight, none above `most` times its size; the excess goes to the others by weight."""
    left, open_weight = Fraction(sum(sizes)), sum(weights)
    out = [Fraction(0)] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: (Fraction(most * sizes[i], weights[i]), i))
    for at, i in enumerate(order):
        if left * weights[i] < most * sizes[i] * open_weight:
            for j in order[at:]:
                out[j] = left * weights[j] / open_weight
            break
        out[i] = Fraction(most * sizes[i])
        left -= out[i]
        open_weight -= weights[i]
    return out


def sainte_lague(claims: Sequence[Fraction | int], seats: int, limits: Sequence[int]) -> list[int]:
    """Seats by highest quotients claim / (2k + 1), no one above its limit; ties go to the earlier claim.

    Starts from the seats that everyone has at a divisor a little above the final one, so that few are dealt one by one.
    """
    total = sum(claims)
    out = [0] * len(claims)
    if not total or seats <= 0:
        return out
    out = [min(m, max(0, int(Fraction(c) * seats / total - Fraction(1, 2)))) for c, m in zip(claims, limits)]
    while sum(out) > seats:
        out = [max(0, n - 1) for n in out]
    heap = [(-Fraction(c) / (2 * n + 1), i) for i, (c, n, m) in enumerate(zip(claims, out, limits)) if c and n < m]
    heapq.heapify(heap)
    for _ in range(seats - sum(out)):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < limits[i]:
            heapq.heappush(heap, (-Fraction(claims[i]) / (2 * out[i] + 1), i))
    return out


def blocks_of(size: int, block: int) -> int:
    return -(-size // block)


def shard_quotas(mix: Mix):
    """For applyInPandas over the shards of one source: the blocks that each of them gives."""

    def run(shards: pd.DataFrame) -> pd.DataFrame:
        shards = shards.sort_values("_shard").reset_index(drop=True)
        sizes = [int(v) for v in shards["_shard_size"]]
        limits = [mix.most * blocks_of(v, mix.block) for v in sizes]
        shards["_quota"] = sainte_lague(sizes, int(shards["_blocks"].iloc[0]), limits)
        return shards[["_source", "_none", "_shard", "_shard_size", "_quota"]]

    return run


def take(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", mix: Mix = Mix()) -> DataFrame:
    """Key, `size`, `source_size`, `target`, `taken` (words taken, repeats counted) of every row.

    A null text has size 0 and takes 0; a null source is a source of its own, the last. Repeated rows are rows. A document
    takes `most` times its size at most. Reruns agree; rows that agree in key, source and size may trade places, with
    equal totals.
    """
    spark = docs.sparkSession
    base = docs.select(docs[key].alias("_key"), docs[source].cast("string").alias("_name"), n_words(docs[text]).alias("_size"))
    base = base.select(
        "_key",
        "_size",
        F.coalesce("_name", F.lit("")).alias("_source"),
        F.col("_name").isNull().alias("_none"),
        F.md5(F.concat_ws("|", F.lit(mix.seed), F.col("_key").cast("string"))).alias("_hash"),
    )
    whole = base.groupBy("_source", "_none").agg(F.sum("_size").alias("n"), F.count("*").alias("rows")).collect()
    rows = sorted(whole, key=lambda r: (r._none, r._source.encode()))
    sizes = [r.n for r in rows]
    weights = [mix.weights[i % len(mix.weights)] for i in range(len(rows))]
    goal = targets(sizes, weights, mix.most)
    seats = blocks_of(sum(sizes), mix.block)
    given = sainte_lague(goal, seats, [mix.most * blocks_of(n, mix.block) for n in sizes])
    plan = spark.createDataFrame(
        [(r._source, r._none, r.n, float(g), b, -(-r.rows // mix.shard_rows)) for r, g, b in zip(rows, goal, given)],
        "_source string, _none boolean, source_size long, target double, _blocks long, _shards long",
    )
    on = ["_source", "_none"]
    # One row per source, a name and five numbers: small enough to broadcast whenever the driver can hold it.
    dealt = base.join(F.broadcast(plan), on).withColumn("_shard", F.conv(F.substring("_hash", 1, 8), 16, 10).cast("bigint") % F.col("_shards"))
    shards = dealt.groupBy(*on, "_shard", "_blocks").agg(F.sum("_size").alias("_shard_size"))
    quotas = shards.groupBy(*on).applyInPandas(shard_quotas(mix), "_source string, _none boolean, _shard long, _shard_size long, _quota long")
    place = W.partitionBy(*on, "_shard").orderBy("_hash", "_key", "_size")
    placed = dealt.withColumn("_last", F.sum("_size").over(place.rowsBetween(W.unboundedPreceding, 0)))
    b = mix.block
    joined = placed.join(quotas, [*on, "_shard"])
    n_blocks = F.ceil(F.col("_shard_size") / b)
    start = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(mix.seed), "_source", F.col("_shard").cast("string"))), 1, 8), 16, 10).cast("bigint")
    joined = joined.withColumns({"_n": n_blocks, "_first": F.col("_last") - F.col("_size")})
    joined = joined.withColumns({"_whole": F.expr("_quota div greatest(_n, 1)"), "_rest": F.expr("_quota % greatest(_n, 1)"), "_from": start % F.greatest("_n", F.lit(1))})

    def overlap(first: Column, last: Column) -> Column:
        """Words of the row in the blocks [first, last)."""
        return F.greatest(F.lit(0), F.least(F.col("_last"), last * b) - F.greatest(F.col("_first"), first * b))

    straight = overlap(F.col("_from"), F.least(F.col("_n"), F.col("_from") + F.col("_rest")))
    around = overlap(F.lit(0), F.greatest(F.lit(0), F.col("_from") + F.col("_rest") - F.col("_n")))
    taken = F.col("_size") * F.col("_whole") + straight + around
    return joined.select(
        F.col("_key").alias(key), F.col("_size").alias("size"), "source_size", "target", taken.cast("bigint").alias("taken")
    )


#: The same for tables of one shard per source, in SQL (DuckDB); the tests cover several shards.
SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS src, source IS NULL AS none,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1' || CASE WHEN doc_id IS NULL THEN '' ELSE '|' || CAST(doc_id AS VARCHAR) END) AS h
  FROM documents),
s AS (
  SELECT src, none, CAST(sum(size) AS BIGINT) AS n,
         CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY none, src) - 1) % 3] AS BIGINT) AS w, row_number() OVER (ORDER BY none, src) AS i
  FROM d GROUP BY src, none),
o AS (
  SELECT *, row_number() OVER (ORDER BY 3.0 * n / w, i) AS k, sum(n) OVER () AS total FROM s),
f AS (
  SELECT *, total - coalesce(sum(3 * n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM o),
c AS (SELECT *, coalesce((SELECT min(k) FROM f WHERE rest * w < 3 * n * ws), 1 << 60) AS cut FROM f),
t AS (
  SELECT src, none, i, n, total, (n + 63) // 64 AS nb,
         CASE WHEN k < cut THEN CAST(3 * n AS HUGEINT) ELSE CAST((SELECT rest FROM c x WHERE x.k = c.cut) * w AS HUGEINT) END AS num,
         CASE WHEN k < cut THEN CAST(1 AS HUGEINT) ELSE CAST((SELECT ws FROM c x WHERE x.k = c.cut) AS HUGEINT) END AS den FROM c),
q AS (
  SELECT src, none, i, unnest(range(0, 3 * nb)) AS j, num, den, total FROM t),
seats AS (
  SELECT src, none, row_number() OVER (ORDER BY CAST(num AS DOUBLE) / CAST(den * (2 * j + 1) AS DOUBLE) DESC, i) AS r, total FROM q WHERE num > 0),
g AS (SELECT src, none, count(*) AS quota FROM seats WHERE r <= (total + 63) // 64 GROUP BY src, none),
p AS (
  SELECT d.doc_id, d.size, t.n, CAST(t.num AS DOUBLE) / CAST(t.den AS DOUBLE) AS target, greatest(t.nb, 1) AS nb, t.nb AS raw_nb, coalesce(g.quota, 0) AS quota,
         CAST(sum(d.size) OVER (PARTITION BY d.src, d.none ORDER BY d.h, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS last,
         CAST('0x' || substr(md5('mix-1|' || d.src || '|0'), 1, 8) AS BIGINT) AS start
  FROM d JOIN t USING (src, none) LEFT JOIN g USING (src, none)),
x AS (SELECT *, last - size AS first, quota // nb AS whole, quota % nb AS rest, start % nb AS fr FROM p)
SELECT doc_id, size, n AS source_size, target,
       CAST(size * whole
         + greatest(0, least(last, least(raw_nb, fr + rest) * 64) - greatest(first, fr * 64))
         + greatest(0, least(last, greatest(0, fr + rest - raw_nb) * 64) - greatest(first, 0)) AS BIGINT) AS taken
FROM x
"""
