"""Cutting lineage in the folder that the cluster shares, and names that a table lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from reelspark.folders import fresh_folder

#: Removes a query's shuffle files when the query has ended; what it wrote no longer needs them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame) -> DataFrame:
    """df, computed once, as a Parquet table in the shared folder (``spark.checkpoint.dir``). Executors may be lost later on: nothing behind the table is needed again, so its shuffle files go."""
    spark = df.sparkSession
    at, before = fresh_folder(spark, "saved"), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(at)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(at)
    out.saved_at = at
    return out


def discarded(table: DataFrame) -> None:
    """Gives back the disk of a table made by ``saved`` that nothing will read again."""
    table.sparkSession.createDataFrame([], table.schema).write.mode("overwrite").parquet(table.saved_at)


def unused(df: DataFrame, *names: str) -> tuple[str, ...]:
    """Names like these that are no columns of df (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return tuple(out)
