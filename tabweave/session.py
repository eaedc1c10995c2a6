"""Session helpers: a builder for local work and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tabweave", cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench, with a warehouse of its own; a cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tabweave-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Where it is not set, as in tests, the warehouse of a local session takes its place, which
    driver and executors share there. On a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/tabweave/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables of this application, once nothing made from them is needed any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table once to the shared folder and read it back.

    Later passes read columns of files instead of repeating a shuffle, also after lost executors.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def lenient(spark: SparkSession) -> Iterator[None]:
    """Expressions built meanwhile give null where they have no value, instead of an error at run time."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def enable_checkpoints(spark: SparkSession) -> None:
    """Point reliable checkpoints at the shared folder unless the session already does."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(f"{shared_root(spark)}/tabweave/checkpoints")
