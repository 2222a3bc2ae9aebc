"""A table with one row for each key that micro-batches are upserted into, with a commit log."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelspark.files import Files
from reelspark.operators.detections import last_wins

BUCKETS = 64
BUCKET = "bucket_of_key"


class KeyedTable:
    """A Parquet table with one row for each key; a batch's rows replace those with its keys.

    Rows lie in ``buckets`` by the hash of their key, and a batch writes only the buckets that it touches, into folders of its own. A manifest, written last
    and under the next number, names the folder of every bucket: a reader sees all of a batch or nothing of it, and a process that dies before the manifest leaves the table as it was.
    The manifest has the last batch of each ``writer`` (a streaming query), so a batch that is run again after its commit changes nothing, while a
    new query may count its batches from 0. All that is known of the table is in its folder: another process, or this one after a restart, goes on where the last commit was.

    One process writes at a time; a second one that commits the same number fails. ``vacuum`` deletes what only manifests older than the last few name.

    ``valid``: rows for which it isn't true (false or null) do no harm to the others: they go to a table of their own, ``rejected()``, and not into this one.
    Null keys are keys like others. A table without a commit reads as None.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], valid: Column | None = None, buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.valid, self.buckets = spark, path.rstrip("/"), keys, valid, buckets
        self.files = Files(spark, self.path)

    def versions(self) -> list[int]:
        return [int(name.removesuffix(".json")) for name in self.files.names(f"{self.path}/log") if name.endswith(".json") and not name.startswith(".")]

    def manifest(self, version: int | None = None) -> dict | None:
        """What a version (the last one) consists of; None before the first commit."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        return json.loads(self.files.text(f"{self.path}/log/{version:020}.json"))

    def read(self, version: int | None = None) -> DataFrame | None:
        of = self.manifest(version)
        return None if of is None else self._rows(of, of["folders"])

    def _rows(self, of: dict, buckets) -> DataFrame:
        schema = StructType.fromJson(of["schema"])
        paths = [f"{of['folders'][b]}/{BUCKET}={b}" for b in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def rejected(self) -> DataFrame | None:
        of = self.manifest()
        return self.spark.read.parquet(f"{self.path}/rejected/*") if of and of["rejected"] else None

    def upsert(self, batch: DataFrame, batch_id: int, order: list[str], writer: str = "") -> bool:
        """Whether the batch changed the table: False if this writer's batch of this number, or a later one, is in it."""
        of = self.manifest() or {"version": -1, "buckets": self.buckets, "folders": {}, "done": {}, "rejected": False, "schema": None}
        if of["done"].get(writer, -1) >= batch_id:
            return False
        batch = batch.persist()
        try:
            good = batch
            if self.valid is not None:
                is_good = F.coalesce(self.valid, F.lit(False))
                good, bad = batch.where(is_good), batch.where(~is_good)
                if not bad.isEmpty():  # under the batch's own name, so that a second run replaces what the first one wrote
                    bad.write.mode("overwrite").parquet(f"{self.path}/rejected/{uuid.uuid5(uuid.NAMESPACE_URL, writer)}-{batch_id}")
                    of["rejected"] = True
            fresh = last_wins(good, self.keys, order).withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(of["buckets"])).cast("int"))
            touched = [str(r[0]) for r in fresh.select(BUCKET).distinct().collect()]
            if touched:
                self._write(of, fresh, touched)
        finally:
            batch.unpersist()
        of["version"] += 1
        of["done"][writer] = batch_id
        if not self.files.publish(f"{self.path}/log/{of['version']:020}.json", json.dumps(of)):
            raise RuntimeError(f"another process wrote version {of['version']} of {self.path}")
        return True

    def _write(self, of: dict, fresh: DataFrame, touched: list[str]) -> None:
        merged, known = fresh, [b for b in touched if b in of["folders"]]
        if known:
            old = self._rows(of, known).withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(of["buckets"])).cast("int"))
            new = fresh.select(*[F.col(k).alias(f"new_{i}") for i, k in enumerate(self.keys)])
            same = reduce(lambda a, b: a & b, [old[k].eqNullSafe(new[f"new_{i}"]) for i, k in enumerate(self.keys)])
            merged = fresh.unionByName(old.join(new, same, "left_anti"), allowMissingColumns=True)
        folder = f"{self.path}/data/{of['version'] + 1:020}-{uuid.uuid4().hex}"
        merged.repartition(BUCKET).write.partitionBy(BUCKET).parquet(folder)
        of["folders"] |= dict.fromkeys(touched, folder)
        before = None if of["schema"] is None else StructType.fromJson(of["schema"])
        rows = merged.drop(BUCKET).schema
        of["schema"] = StructType([*rows, *[f for f in before or [] if f.name not in rows.names]]).jsonValue()

    def vacuum(self, keep: int = 2) -> int:
        """Deletes older manifests than the last ``keep`` and the folders that none of these name; gives the number of folders that went. Not while a batch is written."""
        known = self.versions()
        stay = {f.rsplit("/", 1)[1] for v in known[-keep:] for f in self.manifest(v)["folders"].values()}
        gone = [name for name in self.files.names(f"{self.path}/data") if name not in stay]
        for v in known[:-keep]:
            self.files.delete(f"{self.path}/log/{v:020}.json")
        for name in gone:
            self.files.delete(f"{self.path}/data/{name}")
        return len(gone)


def upsert_stream(stream: DataFrame, table: KeyedTable, order: list[str], checkpoint: str, interval: str | None = None):
    """Starts the stream into the table: every ``interval`` (such as 250 milliseconds), or what is there now. The checkpoint names the writer."""
    writer = stream.writeStream.foreachBatch(lambda batch, k: table.upsert(batch, k, order, checkpoint)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
