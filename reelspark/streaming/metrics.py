"""What streams have done: counts of each batch, a table of progress, and queries that start one after another."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = "name string, run string, batch bigint, at timestamp, input_rows bigint, seconds double, counts map<string,bigint>, error string"


def counted(rows: DataFrame, name: str, **flags) -> DataFrame:
    """rows, with counts that their progress reports: ``rows``, and for each flag (a boolean column) the rows for which it is true. No further pass over the data."""
    return rows.observe(name, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in flags.items()])


class ProgressTable(StreamingQueryListener):
    """Keeps a row for each batch of each query of the session, and one with ``error`` for a query that failed; ``flush`` appends what has come to a Parquet table in the folder.

    Rows wait in the driver, one for each batch, until they are flushed: every ``each`` of them, or on demand. Batches without rows are kept too.
    """

    def __init__(self, spark: SparkSession, path: str, each: int = 1000):
        self.spark, self.path, self.each = spark, path, each
        self._rows: list[tuple] = []
        self._names: dict[str, str | None] = {}
        self._lock = threading.Lock()
        self.ended = 0

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
        self.flush()

    def onQueryStarted(self, event) -> None:
        self._names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        counts = {k: int(v) for row in p.get("observedMetrics", {}).values() for k, v in row.items()}
        self._keep((p.get("name"), p["runId"], p["batchId"], p["timestamp"], p["numInputRows"], p["durationMs"].get("triggerExecution", 0) / 1000, counts, None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        name = self._names.pop(str(event.runId), None)
        if event.exception:
            self._keep((name, str(event.runId), None, None, 0, None, {}, event.exception))
        self.ended += 1

    def _keep(self, row: tuple) -> None:
        with self._lock:
            self._rows.append(row)
            full = len(self._rows) >= self.each
        if full:
            self.flush()

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            made = self.spark.createDataFrame(rows, PROGRESS.replace("at timestamp", "at string"))
            made.withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).parquet(self.path)


def settled(table: ProgressTable, queries: int, timeout: float = 10.0) -> bool:
    """Waits until the table has heard of the end of so many queries, for listeners hear of it later than callers; False if that takes longer."""
    began = time.time()
    while table.ended < queries and time.time() - began < timeout:
        time.sleep(0.05)
    return table.ended >= queries


def staged(first: Callable[[], StreamingQuery], *others: Callable[[], StreamingQuery], timeout: float = 30.0, poll: float = 0.1) -> list[StreamingQuery]:
    """Starts the first query, waits until it has made progress (a batch, or it has ended with what was there), and then starts the others.

    A first query that fails raises its error and no other is started; without progress in ``timeout`` seconds it is stopped with TimeoutError.
    """
    query, began = first(), time.time()
    while query.isActive and query.lastProgress is None:
        if time.time() - began > timeout:
            query.stop()
            raise TimeoutError(f"no progress in {timeout} seconds")
        time.sleep(poll)
    if query.exception() is not None:
        raise query.exception()
    return [query, *[start() for start in others]]
