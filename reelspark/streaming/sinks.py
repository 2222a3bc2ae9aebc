"""Sinks: CSV appends, and tables of what a stream gave. Keyed upserts are in ``keyed``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.folders import fresh_folder
from reelspark.streaming.keyed import KeyedTable, upsert_stream


__all__ = ["KeyedTable", "collected", "csv_append", "upsert_stream"]


def collected(stream: DataFrame, spark: SparkSession) -> DataFrame:
    """All that the stream gives from what is there now, as a table in the shared folder."""
    at = fresh_folder(spark, "stream")
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{at}/checkpoint").option("path", f"{at}/rows").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/rows")


def csv_append(stream: DataFrame, path: str, checkpoint: str, interval: str | None = None):
    """Starts the stream into CSV files with a header in each; arrays, maps and structs are written as JSON. Every ``interval``, or what is there now."""
    nested = {f.name: F.to_json(f.name) for f in stream.schema if f.dataType.typeName() in ("array", "map", "struct")}
    writer = stream.withColumns(nested).writeStream.format("csv").option("header", True).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
