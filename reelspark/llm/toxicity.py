"""Toxicity by compression distance between zstandard dictionaries of toxic and of ordinary text.

Training takes a bounded sample of labelled rows (``sample`` of each label, texts of at most ``sample_chars``, chosen by hash). In toxic
documents few words are toxic, so the toxic dictionary is trained on the segments whose byte n-grams are in far more toxic than
ordinary documents; the ordinary dictionary on the most common words. Both are raw-content dictionaries that end in one lead-out, which also follows
each window: zstandard's fixed costs cancel, and the difference of the two compressed lengths is the window's gain. A window is a word of
lower-case text with a space on either side; a run of more than 60 bytes is cut into overlapping windows of 30 that cover all of it. A document's score is a logistic function of its gains, calibrated on
labelled documents that no dictionary has seen; a shift puts the best threshold there at 0.3.

Null or empty text has no windows: it scores as a document without toxic windows. Rows are scored each for itself: ties and repeated rows score alike. With too few
labels of one kind every score is the share of toxic labels. Empty tables give no row. Null labels and ids are not learned from.
Columns that documents have already stay as they are: a score of that name gets an underscore before it.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from reelspark.llm.arrow import steps
from reelspark.llm.labelled import thinned
from reelspark.llm.shared import unused

SAMPLE, SAMPLE_CHARS, CACHE_ENTRIES, DICTIONARY_BYTES, THRESHOLD = 1500, 12_000, 250_000, 4096, 0.3
GRAMS = (5, 8)
WINDOW, STRETCH = 60, 30


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    lead: bytes
    weights: tuple[float, ...]
    prior: float


def windows(text: bytes) -> list[bytes]:
    """The words; a run of more than 60 bytes as stretches of 30 that cover all of it, each beginning 15 after the one before."""
    out = text.split()
    if len(text) <= WINDOW or max(map(len, out), default=0) <= WINDOW:
        return out
    half = STRETCH // 2
    return [x for w in out for x in ([w] if len(w) <= WINDOW else [w[i : i + STRETCH] for i in range(0, len(w) - half, half)])]


def grams(word: bytes) -> set[bytes]:
    w = b" " + word + b" "
    return {w[i : i + n] for n in GRAMS for i in range(max(1, len(w) - n + 1))}


class Known:
    """The n-grams of words, kept as tuples that share their bytes: a tenth of the memory of sets."""

    def __init__(self) -> None:
        self.words: dict[bytes, tuple[bytes, ...]] = {}
        self.pool: dict[bytes, bytes] = {}

    def grams(self, word: bytes) -> tuple[bytes, ...]:
        got = self.words.get(word)
        if got is None:
            got = tuple(grams(word))
            if len(word) < STRETCH:  # stretches of long runs hardly come again
                got = tuple(self.pool.setdefault(g, g) for g in got)
                self.words[word] = got
        return got


def document_counts(docs: list[bytes], known: Known, among: set[bytes] | None = None) -> Counter:
    """In how many documents each n-gram (of ``among``) is."""
    out: Counter = Counter()
    for t in docs:
        found: set[bytes] = set()
        for w in set(windows(t)):
            found.update(known.grams(w))
        out.update(found if among is None else found & among)
    return out


def segments(word: bytes, chosen: dict[bytes, int]) -> list[bytes]:
    """Stretches of the word covered by chosen n-grams that are at least half as common as its most common one."""
    w = b" " + word + b" "
    spots = [(i, min(len(w), i + n), chosen[w[i : i + n]]) for n in GRAMS for i in range(max(1, len(w) - n + 1)) if w[i : i + n] in chosen]
    least = max((c for _, _, c in spots), default=0) / 2
    out: list[list[int]] = []
    for a, b, c in sorted(spots):
        if c >= least:
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
    return [w[a:b] for a, b in out]


def dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes, bytes]:
    known = Known()
    n1, n0 = len(toxic), len(ordinary)
    hot = {k: c for k, c in document_counts(toxic, known).items() if c >= max(3, n1 // 200)}
    cold = document_counts(ordinary, known, set(hot))
    chosen: dict[bytes, int] = {}
    for k, c in hot.items():
        if c * n0 >= 5 * cold[k] * n1:
            p = (c + cold[k]) / (n1 + n0)
            if (c / n1 - cold[k] / n0) >= 5 * math.sqrt(p * (1 - p) * (1 / n1 + 1 / n0)):
                chosen[k] = c
    counts: Counter = Counter(s for t in toxic for w in set(windows(t)) if not chosen.keys().isdisjoint(known.grams(w)) for s in segments(w, chosen))
    content = b""
    for s, c in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        if c >= 3 and s not in content and len(content) < DICTIONARY_BYTES:
            content += s + b"|"
    common = sorted(Counter(w for t in ordinary for w in windows(t)).items(), key=lambda x: (-x[1], x[0]))
    covered: set[bytes] = set()
    plain = b" "
    for w, _ in common:
        if len(plain) < DICTIONARY_BYTES and len(w) < 40 and not covered.issuperset(known.grams(w)):
            covered.update(known.grams(w))
            plain += w + b" "
    return content, plain, b" ".join(w for w, _ in common[:200])[:64].ljust(64, b".")


def compressor(content: bytes, lead: bytes):
    how = zstandard.ZstdCompressionParameters.from_level(6, source_size=128, dict_size=len(content) + 64, min_match=5, strategy=zstandard.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False)
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content + lead, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=how).compress


class Scorer:
    def __init__(self, model: Model):
        self.model, self.gains = model, {}
        self.toxic, self.ordinary = compressor(model.toxic, model.lead), compressor(model.ordinary, model.lead)

    def gain(self, word: bytes) -> int:
        got = self.gains.get(word)
        if got is None:
            window = b" " + word + b" " + self.model.lead
            got = len(self.ordinary(window)) - len(self.toxic(window))
            if len(self.gains) < CACHE_ENTRIES:
                self.gains[word] = got
        return got

    def features(self, text: bytes) -> list[float]:
        words = windows(text.lower())
        g = np.fromiter(map(self.gain, words), np.int64, len(words))
        top = np.sort(g)[-2:].sum() if len(g) > 1 else g.sum()
        strong = (g >= 3).sum(), (g >= 4).sum()
        return [1.0, max(-4.0, float(top)), math.log1p(strong[0]), math.log1p(strong[1]), 100 * strong[0] / (len(g) + 40), math.log1p(len(g))]

    def score(self, text: bytes) -> float:
        if not self.model.weights:
            return self.model.prior
        z = float(np.dot(self.model.weights, self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights by Newton steps, on features of unit spread; the first is the constant."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    mean[0], spread[0] = 0, 1
    z, w = (x - mean) / spread, np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w = w - np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (p - y) + penalty * w)
    w = w / spread
    w[0] -= (w * mean)[1:].sum()
    return w


def train(rows: list[tuple[bytes, int]]) -> Model:
    """rows: (text, label). Seven in ten make the dictionaries, the others calibrate."""
    sides = [sorted((t.lower() for t, y in rows if y == k), key=zlib.crc32) for k in (0, 1)]
    n0, n1 = map(len, sides)
    if n0 < 4 or n1 < 4:
        return Model(b"", b"", b"", (), n1 / (n0 + n1) if n0 + n1 else 0.0)
    cut0, cut1 = n0 * 7 // 10, n1 * 7 // 10
    made = dictionaries(sides[1][:cut1], sides[0][:cut0])
    scorer = Scorer(Model(*made, (), 0.0))
    x = np.array([scorer.features(t) for t in sides[0][cut0:] + sides[1][cut1:]])
    y = np.array([0.0] * (n0 - cut0) + [1.0] * (n1 - cut1))
    w = logistic(x, y)
    z = x @ w
    order = np.argsort(-z)
    right, wrong = np.cumsum(y[order]), np.cumsum(1 - y[order])
    best = int(np.argmax(2 * right / (y.sum() + right + wrong)))  # the F measure
    cut = (z[order[best]] + (z[order[best + 1]] if best + 1 < len(z) else z[order[best]])) / 2
    w[0] += math.log(THRESHOLD / (1 - THRESHOLD)) - cut
    return Model(*made, tuple(w.tolist()), n1 / (n0 + n1))


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with their own columns."""
    (column,) = unused(docs, "_toxicity")
    return score(docs, model, text, column).where(F.col(column) < threshold).select(*docs.columns)


def fit(labelled: DataFrame, text: str = "text", label: str = "toxic", sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Learns from at most ``sample`` rows of each label (twice as many ordinary ones)."""
    base = labelled.select(F.col(text).alias("t"), F.col(label).alias("y")).where(f"t is not null and y in (0, 1) and length(t) <= {int(sample_chars)}")
    rows = []
    for y, n in ((1, sample), (0, 2 * sample)):
        rows += [(r.t.encode(), y) for r in thinned(base.where(F.col("y") == y), "t", n).orderBy(F.xxhash64("t"), "t").limit(n).select("t").collect()]
    return train(rows)


def score(docs: DataFrame, model: Model, text: str = "text", column: str = "toxicity", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of docs (all, if None) and ``column`` double."""
    ready = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema if keep is None or f.name in keep]
    (column,) = unused(docs.select(*[f.name for f in kept]), column)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(ready.value)
        for batch, raw in steps(batches, text):
            yield batch.select([f.name for f in kept]).append_column(column, pa.array([scorer.score(x) for x in raw], pa.float64()))

    return docs.mapInArrow(each, StructType([*kept, StructField(column, DoubleType())]))


_scorers: dict[Model, Scorer] = {}


def scorer_of(model: Model) -> Scorer:
    """Kept by the worker process, for its later tasks."""
    if model not in _scorers:
        _scorers.clear()
        _scorers[model] = Scorer(model)
    return _scorers[model]
