"""Model files that workers get from Spark and load once, and detection by the nearest centroid."""

from __future__ import annotations

import hashlib
import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.analyzers import InferenceAnalyzer, ThreeModelAnalyzer, loaded
from reelspark.folders import shared_root


@dataclass(frozen=True)
class ModelFile:
    """A file that Spark hands to every worker that asks for it. Its name holds the hash of its content, so that a new version never meets an old copy."""

    name: str
    digest: str

    def opened(self, load: Callable[[bytes], object]) -> object:
        """load(content) in a worker, once for each process and content; a content with another hash than the driver's fails."""

        def checked() -> object:
            with open(SparkFiles.get(self.name), "rb") as f:
                content = f.read()
            if hashlib.sha256(content).hexdigest() != self.digest:
                raise ValueError(f"{self.name} is not what the driver sent")
            return load(content)

        return loaded((load.__module__, load.__qualname__, self.digest), checked)


def shipped(spark: SparkSession, content: bytes, name: str) -> ModelFile:
    """Puts the content into the shared folder and has Spark distribute it. The same content again costs nothing."""
    digest = hashlib.sha256(content).hexdigest()
    model = ModelFile(f"{digest[:16]}-{name}", digest)
    store, folder = fs.FileSystem.from_uri(f"{shared_root(spark)}/models")
    at = f"{folder}/{model.name}"
    if store.get_file_info(at).type == fs.FileType.NotFound:
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{at}.draft") as f:
            f.write(content)
        store.move(f"{at}.draft", at)
    spark.sparkContext.addFile(f"{shared_root(spark)}/models/{model.name}")
    return model


def fit_centroids(vectors: DataFrame, label: str, vector: str) -> bytes:
    """A model file with the mean vector of each label: as many numbers as labels times dimensions come to the driver. Null labels, vectors and values aren't learned from."""
    values = vectors.where(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("label"), F.posexplode(F.col(vector).cast("array<double>")).alias("at", "value"))
    rows = values.groupBy("label", "at").agg(F.avg("value").alias("mean")).collect()
    labels, size = sorted({r.label for r in rows}), 1 + max((r.at for r in rows), default=-1)
    means = np.zeros((len(labels), size))
    for r in rows:
        means[labels.index(r.label), r.at] = r.mean
    out = io.BytesIO()
    np.savez(out, labels=np.array(labels, dtype=str), means=means)
    return out.getvalue()


def read_centroids(content: bytes) -> tuple[list[str], np.ndarray]:
    """Labels, and their means with length 1."""
    with np.load(io.BytesIO(content)) as f:
        means = f["means"]
        return f["labels"].tolist(), means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-300)


def nearest(vectors: list[np.ndarray], model: tuple[list[str], np.ndarray]) -> tuple[list[str], np.ndarray]:
    """The label of the mean with the greatest cosine, the first of equal ones, and that cosine; a vector of zeros has cosine 0 with all."""
    labels, means = model
    x = np.stack(vectors).astype(np.float64)
    cosine = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)) @ means.T
    best = cosine.argmax(1)
    return [labels[k] for k in best], cosine[np.arange(len(best)), best]


class CentroidAnalyzer(InferenceAnalyzer):
    """Labels frames by the nearest centroid of a model file. Parameters: ``model``, a ModelFile; threshold and batch_size as for any inference. frames: match_id, frame_number, vector; null vectors give no row."""

    def load(self) -> Callable[[pd.DataFrame], pd.DataFrame]:
        model = self.params["model"].opened(read_centroids)

        def predict(b: pd.DataFrame) -> pd.DataFrame:
            label, cosine = nearest(b.vector.tolist(), model)
            return pd.DataFrame({"match_id": b.match_id, "frame_number": b.frame_number, "object_label": label, "confidence": cosine, "bbox": [[0, 0, 1, 1]] * len(b)})

        return predict

    def transform(self, frames: DataFrame) -> DataFrame:
        return super().transform(frames.where(F.col("vector").isNotNull()))


class CentroidModels(ThreeModelAnalyzer):
    """Several model files over one pass of the frames. A model answers for a frame if its best cosine is at least ``least``. Parameters: ``files``, a ModelFile for each model; least; batch_size."""

    def load(self) -> Callable[[pd.DataFrame], pd.DataFrame]:
        opened = [f.opened(read_centroids) for f in self.params["files"]]
        least = float(self.params.get("least", 0))

        def rows(b: pd.DataFrame) -> Iterator[tuple]:
            for name, model in zip(self.models, opened, strict=True):
                label, cosine = nearest(b.vector.tolist(), model)
                for match, frame, x, c in zip(b.match_id, b.frame_number, label, cosine, strict=True):
                    if c >= least:
                        yield match, frame, name, [[0.0, 0.0, 1.0, 1.0]], [float(c)], [float(x)]

        return lambda b: pd.DataFrame(rows(b), columns=["match_id", "frame_number", "model", "boxes", "confidences", "classes"])

    def transform(self, frames: DataFrame) -> DataFrame:
        return super().transform(frames.where(F.col("vector").isNotNull()))
