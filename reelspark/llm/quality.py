"""Quality by nearest-neighbour voting in a latent-semantic space.

Terms describe how a text is written: runs of 1 to 3 squeezed character classes (upper case, lower case, digit, space, line end; other characters
stand for themselves), hashed to 2^12, and marks for how long it is, how its words repeat and how long its words are. Document frequencies are
counted over all documents. Vectors are log term counts times inverse document frequency, of unit length, projected on the leading singular vectors of the labelled sample (at
most ``sample`` of each label, chosen by hash), and again of unit length. The labelled vectors (at most 2 x ``sample`` x ``dimensions`` numbers) are
broadcast. Each document's exact cosines with all of them come from blocked products; the ``neighbours`` nearest, and any that tie with the last of
them, vote with their labels by weight of similarity.

Null or empty text has only marks, and a score like other texts. Without labelled rows all scores are 0.5. Repeated rows score alike. An empty table gives no row.
Columns that documents have already stay as they are: a score of that name gets an underscore before it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from reelspark.llm.arrow import mix, steps, sub_hash
from reelspark.llm.labelled import thinned
from reelspark.llm.shared import unused
from reelspark.llm.shingles import word_hashes

TERM_BITS, MARKS, DIMENSIONS, SAMPLE, NEIGHBOURS, SHARPNESS, SAMPLE_CHARS, BLOCK = 12, 64, 64, 2000, 24, 8.0, 40_000, 256
TERMS = (1 << TERM_BITS) + MARKS
CLASSES = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else 32 if b in (9, 11, 12, 13) else b for b in range(256))


def term_counts(texts: list[bytes]) -> np.ndarray:
    """A row of term counts for each text."""
    out = np.zeros((len(texts), TERMS), np.float32)
    hashes, bounds = word_hashes(texts)
    for k, text in enumerate(texts):
        shape = np.frombuffer(text.translate(CLASSES), np.uint8)
        if len(shape):
            shape = shape[np.concatenate(([True], shape[1:] != shape[:-1]))].astype(np.uint64)
            for n in (1, 2, 3):
                if len(shape) >= n:
                    ids = (mix(sub_hash(shape + np.uint64(1), n) * np.uint64(2 * n + 1)) >> np.uint64(64 - TERM_BITS)).astype(np.int64)
                    out[k, : 1 << TERM_BITS] += np.bincount(ids, minlength=1 << TERM_BITS)
        words = hashes[bounds[k] : bounds[k + 1]]
        n = len(words)
        again = (words[1:] == words[:-1]).mean() if n > 1 else 0.0
        fresh = len(np.unique(words)) / n if n else 0.0
        marks = (min(15, int(np.log2(n + 1))), 16 + min(15, int(again * 40)), 32 + min(15, int(fresh * 15)), 48 + min(15, int(np.log2(1 + len(text) / (n + 1)) * 3)))
        out[k, [(1 << TERM_BITS) + m for m in marks]] = 20.0
    return out


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    axes: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # labelled x dimensions
    labels: np.ndarray


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(counts) * idf)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many documents each term is, and how many there are: a few kilobytes from each task, added up by salt first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TERMS + 1, np.int64)
        for _, raw in steps(batches, "text"):
            for a in range(0, len(raw), 512):
                total[:TERMS] += (term_counts(raw[a : a + 512]) > 0).sum(0)
            total[TERMS] += len(raw)
        if total.any():
            yield pa.RecordBatch.from_pydict({"salt": pa.array([int(total.sum()) % 61], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist())
        return pa.table({"salt": pa.array([0], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    kind = "salt int, counts binary"
    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, kind).groupBy("salt").applyInArrow(add, kind).groupBy("salt").applyInArrow(add, kind).collect()
    total = sum((np.frombuffer(r.counts, np.int64) for r in rows), np.zeros(TERMS + 1, np.int64))
    return total[:TERMS], int(total[TERMS])


def latent_axes(x: np.ndarray, dimensions: int, seed: int = 1) -> np.ndarray:
    """Leading right singular vectors, by power iteration on a random start."""
    basis = np.random.default_rng(seed).normal(size=(x.shape[1], min(dimensions, *x.shape))).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    return basis


def train(rows: list[tuple[bytes, int]], frequencies: np.ndarray, documents: int, dimensions: int = DIMENSIONS) -> Model | None:
    if not rows:
        return None
    rows = sorted(rows)
    idf = np.log((1 + documents) / (1 + frequencies)).astype(np.float32) + 0.05
    x = np.concatenate([weighted(term_counts([t for t, _ in rows[a : a + BLOCK]]), idf) for a in range(0, len(rows), BLOCK)])
    axes = latent_axes(x, dimensions)
    return Model(idf, axes, unit(x @ axes), np.array([y for _, y in rows], np.float32))


def vote(model: Model | None, texts: list[bytes], neighbours: int = NEIGHBOURS) -> np.ndarray:
    out = np.full(len(texts), 0.5)
    for a in range(0, len(texts) if model else 0, BLOCK):
        x = unit(weighted(term_counts(texts[a : a + BLOCK]), model.idf) @ model.axes)
        near = x @ model.vectors.T
        k = min(neighbours, near.shape[1])
        last = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
        weight = np.where(near >= last[:, None], np.maximum(near, 1e-3) ** SHARPNESS, 0)
        out[a : a + BLOCK] = np.clip(weight @ model.labels / weight.sum(1), 0, 1)
    return out


def fit(labelled: DataFrame, docs: DataFrame, text: str = "text", label: str = "quality", sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Model | None:
    """Vectors of at most ``sample`` rows of each label, of at most ``sample_chars`` characters; frequencies over all of docs."""
    base = labelled.select(F.col(text).alias("t"), F.col(label).alias("y")).where(f"y in (0, 1) and coalesce(length(t), 0) <= {int(sample_chars)}")
    rows = [((r.t or "").encode(), r.y) for y in (0, 1) for r in thinned(base.where(F.col("y") == y), "t", sample).orderBy(F.xxhash64("t"), "t").limit(sample).collect()]
    return train(rows, *document_frequencies(docs, text))


def score(docs: DataFrame, model: Model | None, text: str = "text", column: str = "score", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of docs (all, if None) and ``column`` double."""
    ready = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema if keep is None or f.name in keep]
    (column,) = unused(docs.select(*[f.name for f in kept]), column)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in steps(batches, text):
            yield batch.select([f.name for f in kept]).append_column(column, pa.array(vote(ready.value, raw), pa.float64()))

    return docs.mapInArrow(each, StructType([*kept, StructField(column, DoubleType())]))
