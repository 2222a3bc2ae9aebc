"""Tables as streams whose batches come in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.folders import fresh_folder
from reelspark.operators.ordered import free_names

#: Rows of a batch, about.
BATCH = 200_000


def in_order(rows: DataFrame, order: Column, each: int = BATCH) -> DataFrame:
    """rows as a stream of one file a batch, each a range of ``order`` (a whole number) that begins behind the last one's, whatever files and order the rows came in.

    A range has about ``each`` rows, and more only where many have one number. Spark's file source takes files by their time of modification, so the ranges are written one after another, each by one task. Null comes first.
    """
    spark, at = rows.sparkSession, fresh_folder(rows.sparkSession, "in-order")
    (batch,) = free_names(rows, "batch")
    n = -(-rows.count() // each)
    if not n:
        rows.write.parquet(f"{at}/rows")
    else:
        bounds = sorted(set(rows.agg(F.percentile_approx(order, [k / n for k in range(1, n)], max(10_000, 100 * n))).first()[0] or [])) if n > 1 else []
        number = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < order)) if bounds else F.lit(0)
        rows.withColumn(batch, F.when(order.isNull(), -1).otherwise(number)).repartition(batch).write.partitionBy(batch).parquet(f"{at}/ranges")
        for k in sorted(r[0] for r in spark.read.parquet(f"{at}/ranges").select(batch).distinct().collect()):
            spark.read.schema(rows.schema).parquet(f"{at}/ranges/{batch}={k}").coalesce(1).write.mode("append").parquet(f"{at}/rows")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/rows")
