"""Picture arithmetic in numpy, for Arrow functions: colour spaces, resizing by area, histograms, perceptual hashes.

Pictures are arrays of bytes, height x width x 3 in the order blue, green, red.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np

#: Hue has 180 steps in a byte; grey is so many thousandths of blue, green and red.
HUES, GREY = 180, (114, 587, 299)
BINS, HASH_SIDE, LOW = 50, 32, 8


def picture(frame: bytes, width: int, height: int) -> np.ndarray | None:
    """The frame as an array; None if its size is another."""
    flat = np.frombuffer(frame, np.uint8)
    return flat.reshape(height, width, 3) if len(flat) == 3 * width * height else None


def hsv(bgr: np.ndarray) -> np.ndarray:
    """Hue (in steps of two degrees), saturation and value as bytes, rounded half up. Grey has hue and saturation 0; of equal greatest channels red counts before green, green before blue."""
    b, g, r = (bgr[..., k].astype(np.int64) for k in range(3))
    v = np.maximum(np.maximum(b, g), r)
    d = v - np.minimum(np.minimum(b, g), r)
    safe = np.maximum(d, 1)
    turn, third = np.where(v == r, g - b, np.where(v == g, b - r, r - g)), np.where(v == r, 0, np.where(v == g, 1, 2))
    sixth = HUES // 6
    h = (2 * sixth * (turn + 2 * third * d) + safe) // (2 * safe)
    h = np.where(d == 0, 0, np.where(h < 0, h + HUES, h) % HUES)
    s = np.where(v == 0, 0, (510 * d + v) // np.maximum(2 * v, 1))
    return np.stack([h, s, v], -1).astype(np.uint8)


@cache
def shares(size: int, target: int) -> np.ndarray:
    """target x size: how much of each old row a new one covers, as parts of 1."""
    edges = np.arange(target + 1) * (size / target)
    low, high = edges[:-1, None], edges[1:, None]
    at = np.arange(size)[None]
    return np.clip(np.minimum(high, at + 1) - np.maximum(low, at), 0, None) * (target / size)


def resized(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """The image with each new pixel the mean of the area that it covers; unchanged if it has that size. Doubles, of one or more channels."""
    image = image.astype(np.float64)
    if image.shape[:2] == (height, width):
        return image
    rows, columns = shares(image.shape[0], height), shares(image.shape[1], width)
    return np.moveaxis(rows @ np.moveaxis(image, -1, 0) @ columns.T, 0, -1) if image.ndim == 3 else rows @ image @ columns.T


def as_bytes(image: np.ndarray) -> np.ndarray:
    """Rounded half up to bytes."""
    return np.clip(np.floor(image + 0.5), 0, 255).astype(np.uint8)


def bins(channels: np.ndarray, n: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """The filled bins of the three-dimensional histogram over [0, 256) in each channel, (first * n + second) * n + third, ascending, and their counts."""
    at = channels.reshape(-1, 3).astype(np.int64) * n // 256
    return np.unique((at[:, 0] * n + at[:, 1]) * n + at[:, 2], return_counts=True)


@cache
def cosines(n: int, low: int) -> np.ndarray:
    """low x n: the first basis vectors of the cosine transform (type II, not scaled, without its factor 2). Of the C library, as in SQL: numpy has cosines of its own on some processors."""
    return np.array([[math.cos(math.pi * u * (2 * k + 1) / (2 * n)) for k in range(n)] for u in range(low)])


@cache
def factors(side: int, low: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each pixel, the last first, and each of the low x low cosines: the factors of its row and of its column."""
    c = cosines(side, low)[:, ::-1].T
    return np.repeat(np.repeat(c, low, 1), side, 0), np.tile(c, (side, low))


def slowest(small: np.ndarray, low: int = LOW) -> np.ndarray:
    """The low x low slowest cosines of a square picture of one channel.

    Added pixel by pixel, from the last to the first, and not as a product of matrices, whose order of addition is the library's: cosines that are equal by arithmetic (a picture of one colour has 63 of
    them) differ by rounding alone, and this order rounds as DuckDB's sum does as long as it isn't split among threads.
    """
    rows, columns = factors(len(small), low)
    return np.add.reduce((4 * small).ravel()[::-1, None] * rows * columns, 0)


def perceptual_hash(bgr: np.ndarray, side: int = HASH_SIDE, low: int = LOW) -> int:
    """64 bits as a signed number: which of the low x low slowest cosines of the grey picture, side x side, are above their median; the slowest of all is the highest bit."""
    grey = (bgr.astype(np.int64) @ np.array(GREY)) / 1000
    band = slowest(resized(grey, side, side), low)
    bits = int("".join("1" if x else "0" for x in band > np.median(band)), 2)
    return bits - (1 << 64) if bits >> 63 else bits
