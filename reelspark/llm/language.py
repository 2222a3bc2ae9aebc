"""Language identification: averaged hashed subword embeddings under a linear softmax.

Subwords are runs of 2 to 4 bytes of the text in lower case (ASCII letters; bytes from 0x80 stay), with one space for all that is no letter, none with a space inside. Each
subword has, by its hash, one of 2^15 embeddings; a text is their average, and a linear softmax over it gives the languages. Embeddings and
weights are trained in numpy by stochastic gradient descent, on at most ``sample`` labelled rows chosen by hash; what a trained model adds up for a
subword is one row of scores, so prediction is one look-up for each subword of the whole text. A temperature, fitted on a fifth of the sample that training has not seen,
calibrates the probabilities; a prediction whose probability is below what all but ``reject`` of the right ones there have is rejected.

Null text and text without a letter are ``und`` with score 0. Other texts get a learned language, and ``rejected`` says whether to trust it; ``identify(...,
reject_as_und=True)`` turns rejected ones to ``und``. Without training rows all is ``und``. Equal texts get equal results; empty tables give no row.
Texts of any length are read whole, in pieces of ``PIECE`` bytes. Columns that documents have already stay as they are: a result of that name gets an underscore before it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from reelspark.llm.arrow import mix, steps, sub_hash
from reelspark.llm.labelled import thinned
from reelspark.llm.shared import unused

BUCKET_BITS, DIMENSIONS, EPOCHS, RATE, SAMPLE, SAMPLE_CHARS, REJECT = 15, 16, 6, 0.6, 3000, 12_000, 0.01
SIZES = (2, 3, 4)
PIECE = 1 << 18
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_ascii_letter = re.compile(rb"[A-Za-z]").search


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: bytes  # float32, a row of scores for each bucket
    bias: tuple[float, ...]
    temperature: float
    least: float


def subwords(text: bytes) -> Iterator[np.ndarray]:
    """Buckets of the subwords, a stretch of the text at a time."""
    clean = b" " + b" ".join(text.translate(LETTERS).split()) + b" "
    values = np.frombuffer(clean, np.uint8)
    for a in range(0, len(values), PIECE):
        part = values[a : a + PIECE + max(SIZES) - 1]
        inner = np.concatenate(([0], np.cumsum(part == 32)))
        for n in SIZES:
            h = sub_hash(part.astype(np.uint64) + np.uint64(1), n)[:PIECE]
            if n > 2:
                k = np.arange(len(h))
                h = h[inner[k + n - 1] == inner[k + 1]]
            yield (mix(h * np.uint64(2 * n + 1)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def has_letter(text: bytes) -> bool:
    return bool(_ascii_letter(text)) or any(map(str.isalpha, text.decode()))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(rows: list[tuple[bytes, str]], reject: float = REJECT, seed: int = 1) -> Model | None:
    rows = sorted((t, y) for t, y in rows if has_letter(t))
    languages = tuple(sorted({y for _, y in rows}))
    if not languages:
        return None
    which = {y: k for k, y in enumerate(languages)}
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(rows))
    bags = []
    for k in order:
        ids, counts = np.unique(np.concatenate(list(subwords(rows[k][0]))), return_counts=True)
        bags.append((ids, (counts / counts.sum()).astype(np.float32), which[rows[k][1]]))
    learn = bags[len(bags) // 5 :] if len(bags) >= 10 else bags
    check = bags[: len(bags) // 5] if len(bags) >= 10 else bags
    vectors = draw.normal(0, 0.3, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    weights, bias = np.zeros((DIMENSIONS, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    done, total = 0, EPOCHS * len(learn)
    for _ in range(EPOCHS):
        for k in draw.permutation(len(learn)):
            ids, share, y = learn[k]
            rate = RATE * (1 - done / total)
            done += 1
            x = share @ vectors[ids]
            g = softmax(x @ weights + bias)
            g[y] -= 1
            back = weights @ g
            weights -= rate * np.outer(x, g)
            bias -= 0.1 * rate * g
            vectors[ids] -= (rate * 20) * share[:, None] * back
    table = vectors @ weights
    z = np.array([share @ table[ids] + bias for ids, share, _ in check])
    y = np.array([y for _, _, y in check])
    losses = [(-np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean(), t) for t in np.geomspace(0.1, 10, 41)]
    temperature = float(min(losses)[1])
    p = softmax(z / temperature)
    right = p.argmax(1) == y
    least = float(np.quantile(p.max(1)[right], reject)) if right.any() else 0.0
    return Model(languages, table.astype(np.float32).tobytes(), tuple(bias.tolist()), temperature, least)


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS, **how) -> Model | None:
    """Learns from at most ``sample`` rows with a label, of at most ``sample_chars`` characters, chosen by hash."""
    base = labelled.select(F.col(text).alias("t"), F.col(label).alias("y")).where(f"t is not null and y is not null and length(t) <= {int(sample_chars)}")
    return train([(r.t.encode(), r.y) for r in thinned(base, "t", sample).orderBy(F.xxhash64("t"), "t", "y").limit(sample).collect()], **how)


def identify(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None, reject_as_und: bool = False) -> DataFrame:
    """The columns ``keep`` of docs (all, if None), lang_pred, score and rejected."""
    ready = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema if keep is None or f.name in keep]
    names = unused(docs.select(*[f.name for f in kept]), "lang_pred", "score", "rejected")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = ready.value
        if m is not None:
            table, bias = np.frombuffer(m.table, np.float32).reshape(-1, len(m.languages)), np.array(m.bias)
        for batch, raw in steps(batches, text):
            best, score, rejected = [], [], []
            for x in raw:
                if m is None or not has_letter(x):
                    best.append("und")
                    score.append(0.0)
                    rejected.append(True)
                    continue
                total, n = np.zeros(len(m.languages)), 0
                for ids in subwords(x):
                    total += np.bincount(ids, minlength=1 << BUCKET_BITS) @ table if len(ids) > 1 << BUCKET_BITS else table[ids].sum(0)
                    n += len(ids)
                p = softmax((total / max(1, n) + bias) / m.temperature)
                k = int(p.argmax())
                out = bool(p[k] < m.least)
                best.append("und" if out and reject_as_und else m.languages[k])
                score.append(float(p[k]))
                rejected.append(out)
            out = batch.select([f.name for f in kept])
            for name, values, kind in zip(names, (best, score, rejected), (pa.string(), pa.float64(), pa.bool_()), strict=True):
                out = out.append_column(name, pa.array(values, kind))
            yield out

    return docs.mapInArrow(each, StructType([*kept, *[StructField(n, kind()) for n, kind in zip(names, (StringType, DoubleType, BooleanType), strict=True)]]))
