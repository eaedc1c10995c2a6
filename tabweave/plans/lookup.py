"""Joining a large table with a fitted dictionary (one row per key)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.functions.columns import quoted

BROADCAST_BYTES = 32 << 20
HOT_SHARE = 1000


def key_bytes(dictionary: DataFrame, key: str = "_key") -> int:
    """About what a broadcast of the keys and a number for each would take."""
    wide = F.coalesce(F.octet_length(quoted(key).cast("string")), F.lit(0)) + F.lit(40)
    return dictionary.agg(F.sum(wide.cast("bigint"))).first()[0] or 0


def lookup_join(rows: DataFrame, dictionary: DataFrame, column: str, size_bytes: int, total: int) -> DataFrame:
    """Add ``_v``, the dictionary's value for a column of ``rows``; null where there is none.

    ``dictionary`` has ``_key``, ``_v`` and ``_n`` (rows per key when it was fitted); ``size_bytes``
    is what ``key_bytes`` says of it and ``total`` the sum of ``_n``. A small one is broadcast. Of a
    larger one only the keys with more than 1/HOT_SHARE of all rows are, of which there are at most
    HOT_SHARE; the rows of all other keys are joined by a shuffle, which no key can make uneven.
    """
    names = [quoted(c) for c in rows.columns]
    key = quoted(column)
    if size_bytes <= BROADCAST_BYTES:
        small = F.broadcast(dictionary.select("_key", "_v"))
        return rows.join(small, key == F.col("_key"), "left").select(*names, "_v")
    heavy = F.col("_n") * HOT_SHARE > F.lit(total)
    hot = F.broadcast(dictionary.where(heavy).select(F.col("_key").alias("_hk"), F.col("_v").alias("_hv")))
    cold = dictionary.where(~heavy).select("_key", "_v")
    marked = rows.join(hot, key == F.col("_hk"), "left")
    settled = key.isNull() | F.col("_hk").isNotNull()
    near = marked.where(settled).select(*names, F.col("_hv").alias("_v"))
    far = marked.where(~settled).select(*names).join(cold, key == F.col("_key"), "left").select(*names, "_v")
    return near.unionByName(far)
