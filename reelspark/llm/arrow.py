"""Helpers shared by the Arrow functions of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once inside a task.
STEP_BYTES = 1 << 20


def steps(batches: Iterator[pa.RecordBatch], text: str, step_bytes: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cuts batches into runs of rows of about ``step_bytes`` of text; null text reads as empty bytes."""
    for batch in batches:
        column = batch.column(text).cast(pa.binary())
        total = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = done = 0
        while start < len(column):
            end = min(len(column), int(np.searchsorted(total, done + step_bytes)) + 1)
            yield batch.slice(start, end - start), [x or b"" for x in column.slice(start, end - start).to_pylist()]
            start, done = end, int(total[end - 1])


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (in place), as splitmix64 ends."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def sub_hash(blocks: np.ndarray, width: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of each ``width`` consecutive values, by doubling; result i covers values i to i + width - 1."""
    with np.errstate(over="ignore"):
        power = np.uint64(base | 1)
        have, span, out, done = blocks.astype(np.uint64, copy=False), 1, None, 0
        while True:
            if width & span:
                out = have[: len(have)] if out is None else _joined(out, have, done, power)
                done += span
            if done == width:
                return out
            n = len(have) - span
            if n <= 0:
                return np.empty(0, np.uint64)
            have = have[:n] * power + have[span : span + n]
            power, span = power * power, span * 2


def _joined(left: np.ndarray, right: np.ndarray, done: int, power: np.uint64) -> np.ndarray:
    n = max(0, min(len(left), len(right) - done))
    return left[:n] * power + right[done : done + n]


def run_names(blocks: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Names of each ``width`` consecutive values, by doubling, for telling runs apart: result i covers values i to i + width - 1.

    Unlike ``sub_hash`` each doubling ends in a step that isn't linear, so that no two different runs have one name whatever the seed; with a seed drawn for each use,
    different runs have equal names with a probability of about 2^-64.
    """
    have, span, out, done, level = blocks.astype(np.uint64, copy=False), 1, None, 0, seed
    while True:
        if width & span:
            out = have if out is None else _paired(out, have[done:], level + 1)
            done += span
        if done == width:
            return out
        if len(have) <= span:
            return np.empty(0, np.uint64)
        have, span, level = _paired(have, have[span:], level), span * 2, level + 2


def _paired(left: np.ndarray, right: np.ndarray, key: int) -> np.ndarray:
    n = min(len(left), len(right))
    h = left[:n] * (mix(np.array([key & 0xFFFFFFFFFFFFFFFF], np.uint64))[0] | np.uint64(1))
    h += right[:n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h
