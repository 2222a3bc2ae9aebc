"""Analyzers: named transformations of a frame table, and a runner for requests of them."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator, Mapping
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.operators.detections import MODELS, merge_models
from reelspark.schemas import DETECTIONS

RESERVED = ("analyzer_type", "streamUrl", "matchId")


class Analyzer(ABC):
    """One request: a stream, a match and open parameters."""

    def __init__(self, streamUrl: str, matchId: str | int, **params: object):
        faults = [what for what, value, kinds in (("a stream URL", streamUrl, str), ("a match id", matchId, str | int)) if value is True or not (value and isinstance(value, kinds))]
        if faults:
            raise ValueError(f"{type(self).__name__} lacks {' and '.join(faults)}")
        self.url, self.match, self.params = streamUrl, matchId, params

    @abstractmethod
    def transform(self, frames: DataFrame) -> DataFrame: ...


#: Models of this worker process, by analyzer and parameters: a worker that serves several tasks loads a model once.
_loaded: dict[tuple, object] = {}


def loaded(key: tuple, load: Callable[[], object]) -> object:
    if key not in _loaded:
        _loaded[key] = load()
    return _loaded[key]


def of_size(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """The same rows in batches of ``size``, across the borders of those that come; the last may be smaller."""
    left = None
    for batch in batches:
        left = batch if left is None else pd.concat([left, batch], ignore_index=True)
        whole = len(left) // size * size
        for k in range(0, whole, size):
            yield left.iloc[k : k + size].reset_index(drop=True)
        left = left.iloc[whole:]
    if left is not None and len(left):
        yield left.reset_index(drop=True)


class InferenceAnalyzer(Analyzer):
    """Detections by a model that a worker process loads once. ``load`` returns predict(batch of frames) -> batch of detections.

    Parameters: ``threshold``, the least confidence that is kept; ``batch_size``, the frames given to predict at once (1, as in live use).
    """

    schema = "match_id string, frame_number bigint, object_label string, confidence double, bbox array<int>"

    @abstractmethod
    def load(self) -> Callable[[pd.DataFrame], pd.DataFrame]: ...

    def predictions(self, frames: DataFrame, schema: str) -> DataFrame:
        load, size = self.load, int(self.params.get("batch_size", 1))
        key = (f"{type(self).__module__}.{type(self).__qualname__}", tuple(sorted((k, str(v)) for k, v in self.params.items())))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            yield from map(loaded(key, load), of_size(batches, size))

        return frames.where(F.col("match_id") == str(self.match)).mapInPandas(run, schema)

    def transform(self, frames: DataFrame) -> DataFrame:
        found = self.predictions(frames, self.schema)
        least = self.params.get("threshold")
        return found if least is None else found.where(F.col("confidence") >= float(least))


class ThreeModelAnalyzer(InferenceAnalyzer):
    """Detections by several models over one pass of the frames. predict gives a row (match_id, frame_number, model, boxes, confidences, classes) for each frame and model;
    the result has one wide row for each frame, its arrays empty unless all models answered."""

    models = MODELS

    def transform(self, frames: DataFrame) -> DataFrame:
        keys = ["match_id", "frame_number"]
        every = frames.where(F.col("match_id") == str(self.match)).select(*keys).distinct()
        return merge_models(every, self.predictions(frames, DETECTIONS), keys, self.models)


def run(requests: list[Mapping], registry: Mapping[str, type[Analyzer]], frames: DataFrame) -> DataFrame:
    """All requests' results in one table, with the request's place and type; a bad request fails before anything runs."""
    if not requests:
        raise ValueError("no requests")
    made = []
    for r in requests:
        if r.get("analyzer_type") not in registry:
            raise ValueError(f"unknown analyzer_type {r.get('analyzer_type')!r}")
        made.append((r["analyzer_type"], registry[r["analyzer_type"]](r.get("streamUrl"), r.get("matchId"), **{k: v for k, v in r.items() if k not in RESERVED})))
    parts = [a.transform(frames).withColumns({"request": F.lit(k), "analyzer_type": F.lit(kind)}) for k, (kind, a) in enumerate(made)]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
