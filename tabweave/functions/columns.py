"""Column builders without any fitted state; each returns plain Spark expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The date parts a config may name, with the Spark function for each.
# dayofweek counts from Monday = 0.
DATE_PARTS = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "dayofweek": F.weekday,
    "quarter": F.quarter,
    "hour": F.hour,
}

NUMERIC_TYPES = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
)


def quoted(name: str) -> Column:
    """Column by exact name, also when the name holds dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def typed_lit(value, kind: T.DataType) -> Column:
    """Literal of a type. Dates and times go through text, which no time zone shifts."""
    return F.lit(str(value) if isinstance(value, (date, datetime)) else value).cast(kind)


def check_edges(edges: Sequence[float], labels: Sequence[str] | None) -> None:
    if len(edges) < 2:
        raise ValueError("a bin needs at least two edges")
    if any(b <= a for a, b in zip(edges, edges[1:])):
        raise ValueError(f"bin edges must increase strictly: {list(edges)}")
    if labels is not None:
        if len(labels) != len(edges) - 1:
            raise ValueError(f"{len(edges)} edges need {len(edges) - 1} labels, got {len(labels)}")
        if len(set(labels)) != len(labels):
            raise ValueError(f"bin labels must be unique: {list(labels)}")


def bin_code(value: Column, edges: Sequence[float]) -> Column:
    """Position of the right-closed interval (a, b] that holds the value, else null."""
    v = value.cast("double")
    out = None
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        hit = (v > F.lit(float(a))) & (v <= F.lit(float(b)))
        out = F.when(hit, F.lit(i)) if out is None else out.when(hit, F.lit(i))
    return out


def bin_label(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    v = value.cast("double")
    out = None
    for a, b, label in zip(edges, edges[1:], labels):
        hit = (v > F.lit(float(a))) & (v <= F.lit(float(b)))
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out


def equal_width_edges(lo: float, hi: float, n: int) -> list[float]:
    """n+1 edges over [lo, hi]; the first is moved left by 0.1 % so that lo is inside."""
    if n < 1:
        raise ValueError("the number of bins must be positive")
    lo, hi = float(lo), float(hi)
    if lo == hi:
        pad = 0.001 * abs(lo) if lo != 0 else 0.001
        lo, hi = lo - pad, hi + pad
        return [lo + (hi - lo) * i / n for i in range(n)] + [hi]
    step = (hi - lo) / n
    edges = [lo + step * i for i in range(n)] + [hi]
    edges[0] -= (hi - lo) * 0.001
    return edges


def _shorten(x: float, digits: int) -> float:
    if not math.isfinite(x) or x == 0:
        return x
    frac, whole = math.modf(x)
    places = digits if whole != 0 else -math.floor(math.log10(abs(frac))) - 1 + digits
    return round(x, places)


def interval_labels(edges: Sequence[float]) -> list[str]:
    """Text such as ``(0.0, 18.5]``, with the fewest digits (3 or more) that keep edges apart."""
    values: Sequence[float] = edges
    if any(isinstance(e, float) for e in edges):
        values = [float(e) for e in edges]
    shown = list(values)
    for digits in range(3, 20):
        shown = [v if isinstance(v, int) else _shorten(v, digits) for v in values]
        if len(set(shown)) == len(shown):
            break
    return [f"({a}, {b}]" for a, b in zip(shown, shown[1:])]


def date_part(value: Column, part: str) -> Column:
    if part not in DATE_PARTS:
        raise ValueError(f"unknown date part {part!r}; valid: {', '.join(DATE_PARTS)}")
    return DATE_PARTS[part](value)


# Date texts that are understood besides ISO dates and times, in this order.
DATE_FORMATS = ("MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm", "MM/dd/yyyy", "M/d/yyyy", "yyyy/MM/dd", "dd-MMM-yyyy")


def timestamp_of(name: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """A text column as a timestamp without zone: ISO first, then the formats in turn; null where none fits."""
    tries = [F.try_to_timestamp(quoted(name), F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(quoted(name).try_cast("timestamp_ntz"), *tries)


def interaction(a: Column, b: Column) -> Column:
    return a.cast("double") * b.cast("double")


def power(a: Column, degree: int) -> Column:
    return F.pow(a.cast("double"), F.lit(float(degree)))


def rescale(value: Column, centre: float, spread: float) -> Column:
    """(x - centre) / spread with literals; a zero spread divides by one."""
    return (value.cast("double") - F.lit(float(centre))) / F.lit(float(spread) or 1.0)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def hash_key(keys: Sequence[Column], seed: int = 42, method: str = "md5") -> Column:
    """60-bit number from the keys. ``md5`` of seed and key text is the same in any SQL engine."""
    if method == "md5":
        text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
        number = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
        # Never null; saying so spares a null check that would compute the hash twice.
        return F.coalesce(number, F.lit(0).cast("bigint"))
    if method == "xxhash64":
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 4)
    raise ValueError(f"unknown hash {method!r}; use md5 or xxhash64")


def hash_percent(keys: Sequence[Column], seed: int = 42, method: str = "md5") -> Column:
    """Bucket 0..99 per row; needs no statistics and no shuffle."""
    return (hash_key(keys, seed, method) % F.lit(100)).cast("int")


def linear_score(weights: dict[str, float], intercept: float = 0.0) -> Column:
    out = F.lit(float(intercept))
    for name, w in weights.items():
        out = out + F.lit(float(w)) * quoted(name).cast("double")
    return out


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def truthy_label(value: Column) -> Column:
    """1 for the text or value True / 1, else 0; a null counts as 0."""
    return F.when(value.cast("string").isin("True", "true", "1"), F.lit(1)).otherwise(F.lit(0))


def risk_level(score: Column) -> Column:
    return F.when(score > F.lit(0.5), F.lit("HIGH RISK")).otherwise(F.lit("LOW RISK"))
