"""Hashed word shingles of whole texts, for Arrow functions."""

from __future__ import annotations

import numpy as np

from reelspark.llm.arrow import mix, sub_hash

#: A-Z in lower case, the six ASCII white space characters as a space, all else as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 32 or 9 <= b <= 13 else b for b in range(256))
_table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_table.setflags(write=False)
_power = np.uint64(0xD1342543DE82EF95)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _power, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, in order, and where each text's words begin (one more bound at the end)."""
    buf = np.frombuffer(b" ".join(x.translate(LOWER) for x in texts) + b" ", np.uint8)
    solid = buf != 32
    edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    if len(solid) and solid[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[::2], edge[1::2]
    bounds = np.searchsorted(starts, np.concatenate(([0], np.cumsum([len(x) + 1 for x in texts]))))
    if not len(starts):
        return np.empty(0, np.uint64), bounds
    sizes = ends - starts
    letters = buf[solid]
    first = np.cumsum(sizes) - sizes
    inside = np.arange(len(letters)) - np.repeat(first, sizes)
    words = np.add.reduceat(_table[letters] * _powers(int(sizes.max()))[inside], first)
    return mix(words + sizes.astype(np.uint64)), bounds


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's runs of ``words`` words; a text of fewer words has one, of all of them; without words, none."""
    hashes, bounds = word_hashes(texts)
    runs = mix(sub_hash(hashes, words)) if len(hashes) >= words else hashes[:0]
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(runs[a : b - words + 1]))
        elif b > a:
            out.append(mix(sub_hash(hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(runs[:0])
    return out


def set_signature(values: np.ndarray) -> int:
    """A signed 64-bit hash of a set of hashes."""
    total = mix(values * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)).sum(dtype=np.uint64) + np.uint64(len(values))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])
