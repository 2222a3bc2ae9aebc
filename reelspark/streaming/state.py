"""Operators that keep state for each key: running numbers, greedy debouncing, camera cuts.

Rows of a batch are sorted by their order within the batch; across batches they must come in order, as from a segment stream. State is one number (for cuts the last
frame) for each key. A task holds the rows that one key has in one batch, which the source bounds (maxFilesPerTrigger over files in order of time).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from reelspark.operators.cuts import CORRELATION, LEAST_HAMMING


def number_rows(rows: DataFrame, key: str, order: list[str], name: str = "frame_number", start: str | None = None) -> DataFrame:
    """``name``: 1-based running number in the key, carried on from batch to batch. start: a column whose first value in a key is the number to go on from (null: 0)."""

    def step(_: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(chunks)).sort_values(order, kind="stable")
        first = batch[start].iloc[0] if start else 0
        last = state.get[0] if state.exists else 0 if pd.isna(first) else int(first)
        batch[name] = range(last + 1, last + 1 + len(batch))
        state.update((last + len(batch),))
        yield batch

    schema = StructType([*rows.schema, StructField(name, LongType())])
    return rows.groupBy(key).applyInPandasWithState(step, schema, "last long", "append", GroupStateTimeout.NoTimeout)


def debounce(rows: DataFrame, key: str, order: str, gap: int) -> DataFrame:
    """Greedy: a row is kept if it is at least ``gap`` after the last kept row of its key, in whichever batch."""

    def step(_: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        batch = pd.concat(list(chunks)).sort_values(order, kind="stable")
        kept = []
        for x in batch[order].tolist():
            take = last is None or x - last >= gap
            kept.append(take)
            last = x if take else last
        state.update((last,))
        yield batch[kept]

    return rows.groupBy(key).applyInPandasWithState(step, rows.schema, "last long", "append", GroupStateTimeout.NoTimeout)


def correlated(a: np.ndarray, b: np.ndarray) -> float | None:
    """Pearson correlation; None if one is constant."""
    x, y = a - a.mean(), b - b.mean()
    spread = float(np.sqrt((x @ x) * (y @ y)))
    return float(x @ y) / spread if spread else None


def camera_cuts(frames: DataFrame, key: str, order: str, gap: int, bits: str = "bits", vector: str = "vector", least: int = LEAST_HAMMING, below: float = CORRELATION) -> DataFrame:
    """key, frame_number, cut_frame: each frame compared with the one before it, kept in state across batches; a cut is kept if it is ``gap`` frames after the last kept one.

    Frames are numbered from 1 as they come; a frame without features (null bits or vector) is skipped and gets no number. cut_frame is the frame that differs, frame_number the one before.
    """

    def step(group: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, last, old_bits, old = state.get if state.exists else (0, None, None, None)
        old = None if old is None else np.array(old, np.float64)
        batch = pd.concat(list(chunks)).sort_values(order, kind="stable")
        found = []
        for now_bits, now in zip(batch[bits], batch[vector], strict=True):
            number, now, now_bits = number + 1, np.asarray(now, np.float64), int(now_bits)
            if old is not None and ((now_bits ^ old_bits) & 0xFFFFFFFFFFFFFFFF).bit_count() >= least and (last is None or number - last >= gap):
                r = correlated(old, now)
                if r is None or not r >= below:
                    last = number
                    found.append(number)
            old, old_bits = now, now_bits
        state.update((number, last, old_bits, None if old is None else old.tolist()))
        yield pd.DataFrame({key: [group[0]] * len(found), "frame_number": [x - 1 for x in found], "cut_frame": found})

    schema = StructType([frames.schema[key], StructField("frame_number", LongType()), StructField("cut_frame", LongType())])
    rows = frames.select(key, order, F.col(bits).alias(bits), F.col(vector).cast("array<double>").alias(vector)).where(F.col(bits).isNotNull() & F.col(vector).isNotNull())
    return rows.groupBy(key).applyInPandasWithState(step, schema, "number long, last long, bits long, vector array<double>", "append", GroupStateTimeout.NoTimeout)
