"""Versioned tables: ``root/name/version=N``. A version is immutable once complete."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def list_versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """Complete versions in order. Only folder names are listed; a write without its
    success marker does not count."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}")
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return []
    out = []
    for st in fs.listStatus(base):
        folder = st.getPath()
        key, _, number = folder.getName().partition("=")
        if key == "version" and number.isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")):
            out.append(int(number))
    return sorted(out)


def register(df: DataFrame, root: str, name: str) -> int:
    """Write a new version (one writer at a time) and return its number."""
    done = list_versions(df.sparkSession, root, name)
    version = (done[-1] if done else 0) + 1
    # An unfinished attempt under this number is replaced; complete versions never are.
    df.write.mode("overwrite").parquet(_path(root, name, version))
    return version


def read_version(spark: SparkSession, root: str, name: str, version: int | str | None = None) -> DataFrame:
    """A version, or the newest for None and ``latest``."""
    if version is None or version == "latest":
        done = list_versions(spark, root, name)
        if not done:
            raise FileNotFoundError(f"{name} has no version below {root}")
        version = done[-1]
    return spark.read.parquet(_path(root, name, int(version)))


def parse_dataset_id(dataset_id: str) -> tuple[str, int] | None:
    """``scheme:name:version`` -> (name, version), or None if it has another form."""
    parts = dataset_id.split(":")
    if len(parts) == 3 and parts[2].isdigit():
        return parts[1], int(parts[2])
    return None


def read_registered(spark: SparkSession, data: Mapping[str, Any]) -> DataFrame:
    """By ``dataset_id`` if that works, else by ``dataset_name`` and ``dataset_version``."""
    root = data["dataset_root"]
    found = parse_dataset_id(data["dataset_id"]) if data.get("dataset_id") else None
    if found is not None and found[1] in list_versions(spark, root, found[0]):
        return read_version(spark, root, *found)
    return read_version(spark, root, data["dataset_name"], data.get("dataset_version"))


def _path(root: str, name: str, version: int) -> str:
    return f"{root.rstrip('/')}/{name}/version={version}"
