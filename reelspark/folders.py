"""Folders that all nodes share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Where it is unset, a local master (one JVM) gets a temporary folder; a cluster fails, for its nodes would not find that folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all nodes share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="reelspark-"))
    return _own[0]


def fresh_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_root(spark)}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame, kind: str = "stored") -> DataFrame:
    """df, computed once, as a Parquet table in the shared folder: what an executor held may be lost afterwards."""
    at = fresh_folder(df.sparkSession, kind)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
