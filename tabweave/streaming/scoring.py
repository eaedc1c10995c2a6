"""Scoring a stream of JSON requests. Scoring keeps no state; answering repeated requests once does, under a watermark."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tabweave.functions.columns import quoted
from tabweave.operators.scoring import align
from tabweave.sources.readers import parse_requests


def request_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    fmt: str = "parquet",
    glob: str | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """Files of requests as they arrive in a folder."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder)


def first_requests(requests: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Requests without their repeats: of equal ``keys`` whose times are at most ``delay`` apart, the first to arrive.

    The state store remembers keys over batches and restarts until the watermark, the latest time seen less ``delay``, has
    passed them; state is bounded by the requests of that span. Requests that arrive behind the watermark are dropped, as
    nothing can say any more whether they were answered. A request without one of its keys or without a time cannot be told
    from others, so it passes each time. On a table instead of a stream, equal keys keep one row whatever their times.
    """
    told = [quoted(c).isNotNull() for c in (*keys, time)]
    known = told[0]
    for t in told[1:]:
        known = known & t
    if not requests.isStreaming:
        return requests.where(known).dropDuplicates(list(keys)).unionByName(requests.where(~known))
    # A watermark needs an instant; a time without zone is read in the session's. The column itself stays as it is.
    marked = requests.withColumn("_seen", quoted(time).cast("timestamp")).withWatermark("_seen", delay)
    once = marked.where(known).dropDuplicatesWithinWatermark(list(keys))
    return once.unionByName(marked.where(~known)).drop("_seen")


def score_requests(
    requests: DataFrame,
    body: str,
    contract: T.StructType,
    score: Callable[[DataFrame], DataFrame],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse, align to the contract and score; works on a stream and on a table.

    A request that cannot be parsed keeps its row, with ``error`` set and null features;
    ``score`` must accept null features.
    """
    parsed = parse_requests(requests, body, contract, keep)
    kept = T.StructType([parsed.schema[k] for k in keep] + [parsed.schema["error"]])
    aligned = align(parsed, T.StructType([*kept.fields, *contract.fields]))
    return score(aligned)


def run_available(scored: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Process what is there, then stop. The checkpoint makes a restart exactly-once."""
    query = (
        scored.writeStream.format(fmt)
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
