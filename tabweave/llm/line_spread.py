"""Line dedup by the spread of lines over sites.

A line (trimmed) is boilerplate when it stands on at least `min_sites` sites and its surroundings differ: the pairs of
neighbouring lines around it are at least `min_contexts_percent` of its occurrences. Lines of copied documents keep their
surroundings and are left to the near-copy join. Lines too short to tell, and lines found too seldom, are never counted.

Per line hash, HyperLogLog sketches of the sites and of the surroundings merge by aggregation, before and after the
shuffle, so a line found everywhere is one small row per task. Lines whose estimates lie near a threshold get exact
distinct counts. Boilerplate lines leave every document; everything else of a text stays as it is.

The SQL fixes that rule for the query. With `by_content` (the pipeline), copies of a document are one document on one site,
a run of widespread lines is judged by what surrounds the run, and short lines count too, from `min_sites_short` sites.
Where widespread lines are more than half of a document, as in near copies, its lines keep their own neighbours. Sites and
surroundings are estimated by the same sketches, and counted exactly near the thresholds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabweave.llm.mixing import n_words
from tabweave.llm.repeats import row_key
from tabweave.session import written


@dataclass(frozen=True)
class Spread:
    """Estimates within `near_percent` of a threshold, at least by 3, are counted exactly."""

    min_sites: int = 5
    min_contexts_percent: int = 50
    min_words: int = 3
    min_chars: int = 16
    near_percent: int = 20
    log_size: int = 12
    by_content: bool = False
    min_sites_short: int = 20
    max_spread_percent: int = 50


def lines(docs: DataFrame, doc: str, text: str, site: str, spread: Spread) -> DataFrame:
    """(key, at, line, site, around) of every line that is long enough; hashes of the line and of its two neighbours."""
    rows = docs.select(row_key(docs, doc, text).alias("key"), docs[site].cast("string").alias("site"), F.split(docs[text].cast("string"), "\n").alias("parts"))
    out = rows.select("key", "site", "parts", F.posexplode("parts").alias("at", "raw")).withColumn("trimmed", F.trim("raw"))
    out = out.where((F.length("trimmed") >= spread.min_chars) & (n_words(F.col("trimmed")) >= spread.min_words))
    before = F.when(F.col("at") > 0, F.trim(F.get("parts", F.col("at") - 1)))
    after = F.trim(F.get("parts", F.col("at") + 1))
    return out.select("key", "at", F.xxhash64("trimmed").alias("line"), F.coalesce("site", F.lit("")).alias("site"), F.xxhash64(*[F.coalesce(F.concat(F.lit("1"), c), F.lit("0")) for c in (before, after)]).alias("around"))


def _near(estimate: Column, threshold: Column, spread: Spread) -> Column:
    return F.abs(estimate - threshold) <= F.greatest(F.lit(3), threshold * spread.near_percent / 100)


def frequent(found: DataFrame, spread: Spread) -> DataFrame:
    """The lines found often enough to stand on `min_sites` sites, written once for the steps that follow."""
    often = found.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= spread.min_sites)
    return written(found.join(often.select("line"), "line", "left_semi"), "lines")


def boilerplate(counted: DataFrame, spread: Spread) -> DataFrame:
    """The line hashes that are boilerplate (one column), of lines found often."""
    sketches = counted.groupBy("line").agg(
        F.count("*").alias("n"),
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(spread.log_size))).alias("sites"),
        F.hll_sketch_estimate(F.hll_sketch_agg("around", F.lit(spread.log_size))).alias("contexts"),
    )
    least = F.col("n") * spread.min_contexts_percent / 100
    near = _near(F.col("sites"), F.lit(spread.min_sites), spread) | _near(F.col("contexts"), least, spread)
    clearly_not = ~near & ((F.col("sites") < spread.min_sites) | (F.col("contexts") < least))
    judged = written(sketches.where(~clearly_not).select("line", near.alias("near")), "spread")
    # Two steps of grouping each, so that a line found everywhere is summed up by site and by surroundings first.
    close = counted.join(judged.where("near").select("line"), "line", "left_semi")
    sites = close.groupBy("line", "site").agg(F.count("*").alias("n")).groupBy("line").agg(F.count("*").alias("sites"), F.sum("n").alias("n"))
    around = close.groupBy("line", "around").agg(F.lit(1).alias("one")).groupBy("line").agg(F.count("*").alias("contexts"))
    exact = sites.join(around, "line").where((F.col("sites") >= spread.min_sites) & (F.col("contexts") * 100 >= F.col("n") * spread.min_contexts_percent))
    return judged.where("NOT near").select("line").unionByName(exact.select("line"))


def runs_of_lines(docs: DataFrame, doc: str, text: str, site: str, spread: Spread) -> DataFrame:
    """(key, content, all, at, rank, size, line, short, site, before, after) of every line with a letter; ranks skip blank lines."""
    rows = docs.select(row_key(docs, doc, text).alias("key"), F.xxhash64(docs[text]).alias("content"), docs[site].cast("string").alias("site"), F.split(docs[text].cast("string"), "\n").alias("parts"))
    own = F.filter(F.transform("parts", lambda p, i: F.struct(i.alias("at"), F.trim(p).alias("line"))), lambda x: n_words(x["line"]) > 0)
    rows = rows.select("key", "content", "site", own.alias("own")).withColumn("all", F.aggregate("own", F.lit(0), lambda n, x: n + F.length(x["line"])))
    out = rows.select("key", "content", "site", "all", "own", F.posexplode("own").alias("rank", "x")).where(F.regexp_like("x.line", F.lit(r"\p{L}")))
    short = (F.length("x.line") < spread.min_chars) | (n_words(F.col("x.line")) < spread.min_words)
    # The first line has no line before it, and is not told from an empty one.
    before = F.when(F.col("rank") > 0, F.get("own", F.col("rank") - 1)["line"])
    after = F.get("own", F.col("rank") + 1)["line"]
    hashes = [F.xxhash64("x.line").alias("line"), F.xxhash64(before).alias("before"), F.xxhash64(after).alias("after")]
    return out.select("key", "content", "all", F.col("x.at").alias("at"), "rank", F.length("x.line").alias("size"), short.alias("short"), F.coalesce("site", F.lit("")).alias("site"), *hashes)


def boilerplate_by_content(counted: DataFrame, spread: Spread) -> DataFrame:
    """The line hashes that are boilerplate (one column), each document content counted once."""
    by_content = [F.min("site").alias("site"), F.first("short").alias("short")]
    least = F.when(F.col("short"), spread.min_sites_short).otherwise(spread.min_sites)
    sketches = counted.groupBy("line", "content").agg(*by_content).groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(spread.log_size))).alias("sites"), F.first("short").alias("short")
    )
    near = _near(F.col("sites"), least, spread)
    judged = written(sketches.where(near | (F.col("sites") >= least)).select("line", near.alias("near")), "spread")
    close = counted.join(judged.where("near").select("line"), "line", "left_semi").groupBy("line", "content").agg(*by_content)
    sites = close.groupBy("line", "site").agg(F.first("short").alias("short")).groupBy("line").agg(F.count("*").alias("sites"), F.first("short").alias("short"))
    wide = written(judged.where("NOT near").select("line").unionByName(sites.where(F.col("sites") >= least).select("line")), "widespread")
    places = counted.join(wide, "line", "left_semi").dropDuplicates(["content", "rank"])
    # Neighbouring widespread lines have one difference of rank and number, and are one run.
    places = places.withColumn("run", F.col("rank") - F.row_number().over(W.partitionBy("content").orderBy("rank")))
    run = W.partitionBy("content", "run")
    mostly = F.sum("size").over(W.partitionBy("content")) * 100 > F.col("all") * spread.max_spread_percent
    ends = [F.min_by("before", "rank").over(run), F.max_by("after", "rank").over(run)]
    around = F.when(mostly, F.xxhash64("before", "after")).otherwise(F.xxhash64(*ends))
    seen = places.select("content", "line", around.alias("around")).groupBy("line", "content").agg(F.min("around").alias("around"))
    seen = written(seen.select("line", "around"), "surroundings")
    sketches = seen.groupBy("line").agg(
        F.count("*").alias("contents"), F.hll_sketch_estimate(F.hll_sketch_agg("around", F.lit(spread.log_size))).alias("contexts")
    )
    least = F.col("contents") * spread.min_contexts_percent / 100
    near = _near(F.col("contexts"), least, spread)
    judged = written(sketches.where(near | (F.col("contexts") >= least)).select("line", "contents", near.alias("near")), "spread")
    close = seen.join(judged.where("near").select("line"), "line", "left_semi")
    contexts = close.groupBy("line", "around").agg(F.lit(1).alias("one")).groupBy("line").agg(F.count("*").alias("contexts"))
    exact = contexts.join(judged, "line").where(F.col("contexts") * 100 >= F.col("contents") * spread.min_contexts_percent)
    return judged.where("NOT near").select("line").unionByName(exact.select("line"))


def dedup(docs: DataFrame, doc: str = "doc_id", text: str = "text", site: str = "source", spread: Spread = Spread()) -> DataFrame:
    """All rows and columns of `docs`, boilerplate lines cut from the text, with `n_lines` and `n_removed` added.

    A null text stays null with 0 lines; an empty one has one empty line. A null site is a site of its own. Repeated rows
    have equal results. Line breaks (\\n) go with the lines they end. Columns called `n_lines` or `n_removed` are replaced.
    """
    found, judge = (runs_of_lines, boilerplate_by_content) if spread.by_content else (lines, boilerplate)
    counted = frequent(found(docs, doc, text, site, spread), spread)
    gone = written(judge(counted, spread), "boilerplate")
    # Rows of a hot line are split by Spark's skew join; the lines themselves are few.
    hits = counted.join(gone, "line").groupBy("key").agg(F.collect_set("at").alias("gone"))
    # The row travels as one value, so that no name of its columns can clash.
    rows = docs.select(row_key(docs, doc, text).alias("key"), docs[text].cast("string").alias("body"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    joined = rows.join(hits, "key", "left")
    parts = F.split("body", "\n")
    kept = F.array_join(F.filter(parts, lambda _, i: ~F.array_contains("gone", i)), "\n")
    new = F.when(F.col("gone").isNull(), F.col("body")).otherwise(kept)
    columns = [new.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    n_lines = F.when(F.col("body").isNull(), 0).otherwise(F.size(parts)).cast("bigint")
    n_removed = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("bigint")
    return joined.select(*columns, n_lines.alias("n_lines"), n_removed.alias("n_removed"))


#: The same with exact counts throughout (DuckDB).
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents),
l AS (
  SELECT rid, source, unnest(parts) AS raw, unnest(range(0, len(parts))) AS pos, parts FROM d),
t AS (
  SELECT rid, pos, trim(raw, ' ') AS line, coalesce(source, '') AS site,
         CASE WHEN pos > 0 THEN trim(parts[pos], ' ') END AS bef, trim(parts[pos + 2], ' ') AS aft FROM l),
c AS (SELECT * FROM t WHERE length(line) >= 16 AND len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 3),
g AS (
  SELECT line FROM (SELECT line, count(*) AS n, count(DISTINCT site) AS s, count(DISTINCT (coalesce('1' || bef, '0'), coalesce('1' || aft, '0'))) AS k FROM c GROUP BY line)
  WHERE s >= 5 AND k * 100 >= n * 50),
r AS (SELECT rid, list(pos) AS gone FROM c WHERE line IN (SELECT line FROM g) GROUP BY rid)
SELECT doc_id, CAST(coalesce(len(parts), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       CASE WHEN gone IS NULL THEN text ELSE
         array_to_string([parts[i + 1] FOR i IN range(0, len(parts)) IF NOT list_contains(gone, i)], chr(10)) END AS text
FROM d LEFT JOIN r USING (rid)
"""
