"""Features of frames of pixels, a batch at a time in Arrow."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from reelspark.functions import pictures as P


def frame_features(frames: DataFrame, width: int | None = None, height: int | None = None, n: int = P.BINS, side: int = P.HASH_SIDE, frame: str = "frame", wide: str = "width", high: str = "height") -> DataFrame:
    """frames with ``bits`` (perceptual hash), ``bins`` (filled bins of the hue, saturation and value histogram, ascending) and ``counts`` in place of the pixels.

    width, height: a picture of another size is resized by area first. A frame that is null, or isn't as long as its size says, has null features and is no picture to compare with.
    Frames are handled one at a time inside a batch; a task holds what Arrow gives it at once.
    """
    names = [c for c in frames.columns if c != frame]

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, filled, counts = [], [], []
            for raw, w, h in zip(batch.column(frame), batch.column(wide).to_pylist(), batch.column(high).to_pylist(), strict=True):
                image = P.picture(raw.as_py(), w, h) if raw.is_valid and w and h else None
                if image is None:
                    found = (None, None, None)
                else:
                    if width and height and (w, h) != (width, height):
                        image = P.as_bytes(P.resized(image, width, height))
                    at, count = P.bins(P.hsv(image), n)
                    found = (P.perceptual_hash(image, side), at, count.astype(np.int64))
                for column, value in zip((bits, filled, counts), found, strict=True):
                    column.append(value)
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(bits, pa.int64()), pa.array(filled, lists), pa.array(counts, lists)], names=[*names, "bits", "bins", "counts"])

    kinds = [*[frames.schema[c] for c in names], StructField("bits", LongType()), *[StructField(c, ArrayType(LongType())) for c in ("bins", "counts")]]
    return frames.mapInArrow(features, StructType(kinds))
