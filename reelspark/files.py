"""Small files of a table's log, through the file system that Spark itself uses for a path."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """Listing, publishing and deleting below a folder on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def text(self, path: str) -> str:
        return "\n".join(r.value for r in self.spark.read.text(path).collect())

    def publish(self, path: str, text: str) -> bool:
        """Writes the file whole or not at all; False if it is there already. Readers never see a part of it: it is renamed into its place."""
        if self._fs.exists(self._path(path)):
            return False
        folder, name = path.rsplit("/", 1)
        draft = self._path(f"{folder}/.{name}.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return bool(self._fs.rename(draft, self._path(path)))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
