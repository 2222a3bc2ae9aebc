"""Benchmark decontamination by Wu-Manber multi-pattern search.

Every run of ``window`` words of a benchmark item is a pattern (an item of fewer words, but not none,
is one pattern). A block shift table skips positions at which no pattern can end; at the others, the hashes of
the pattern's suffix block and prefix block choose the patterns that are compared byte by byte. The benchmark is searched for in blocks of about ``block_bytes``
of text. One block's items are broadcast as they are, and a worker builds the tables of one block at a time. With one block, documents are read once and
nothing is shuffled. With more, each block is a job of its own, which writes what it hits by text (128 bits of hash), and the hits of all
blocks are joined with the documents at the end: no task, and not the driver, holds more than one block, whatever the benchmark's size.

Null or empty text has no words; a null item text gives no pattern; an item whose id is null marks words as hit but is not listed.
Repeated rows are handled row by row; items that share an id count once. Input columns that are not asked for are ignored.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.llm.arrow import steps
from reelspark.llm.shared import saved, unused

#: A-Z in lower case, digits, a-z and bytes from 0x80 as they are, all else a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
END = 0xFF  # never in UTF-8: a word of its own between documents
TABLE_BITS = 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
CHUNK = 2048
BLOCK_BYTES = 4 << 20
SHORT = 24  # patterns below this many bytes are searched apart, or they'd keep all shifts small


def item_patterns(text: bytes, window: int) -> list[bytes]:
    words = text.translate(WORD_BYTES).split()
    return [b" " + b" ".join(words[i : i + window]) + b" " for i in range(max(1, len(words) - window + 1))] if words else []


class WuManber:
    """Search for patterns of at least 3 bytes."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.m = m = min(map(len, patterns))
        self.b = b = min(8, m, max(3, m // 3))
        self.cut = np.uint64(8 * (8 - b))
        heads = np.frombuffer(b"".join(p[:m] for p in patterns), np.uint8).reshape(-1, m)
        self.shift = np.full(1 << TABLE_BITS, m - b + 1, np.uint32)
        values = np.zeros((len(patterns), m - b + 1), np.uint64)
        for k in range(b):
            values |= heads[:, k : k + m - b + 1].astype(np.uint64) << np.uint64(8 * k)
        for j in range(m - b + 1):
            np.minimum.at(self.shift, self._slot(values[:, j]), m - b - j)
        self.keys, self.buckets = np.empty(0, np.uint64), {}
        for i, key in enumerate((self._pair(values[:, -1], values[:, 0])).tolist()):
            self.buckets.setdefault(key, []).append(i)
        self.keys = np.array(sorted(self.buckets), np.uint64)

    @staticmethod
    def _slot(v: np.ndarray) -> np.ndarray:
        return (v * MULTIPLIER) >> np.uint64(64 - TABLE_BITS)

    @staticmethod
    def _pair(suffix: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        return suffix * MULTIPLIER ^ (prefix * MULTIPLIER >> np.uint64(7))

    def find(self, data: bytes) -> list[tuple[int, int]]:
        """(start, pattern) of each occurrence. data must begin with 8 bytes that are in no pattern."""
        buf = np.frombuffer(data, np.uint8)
        if len(buf) < self.m + 8:
            return []
        eights = np.lib.stride_tricks.as_strided(buf, (len(buf) - 7, 8), (1, 1))
        value = lambda end: eights[end - 7].view("<u8")[:, 0] >> self.cut  # noqa: E731  the block that ends there
        cursor = np.arange(7 + self.m, len(buf), CHUNK)  # ends of windows; each cursor has those of its chunk
        last = np.minimum(cursor + CHUNK, len(buf))
        found = []
        while len(cursor):
            step = self.shift[self._slot(value(cursor))]
            if len(hit := cursor[step == 0]):
                found.append(hit)
            cursor = cursor + np.maximum(step, 1)
            live = cursor < last
            cursor, last = cursor[live], last[live]
        if not found:
            return []
        ends = np.concatenate(found)
        key = self._pair(value(ends), value(ends - self.m + self.b))
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        kept = self.keys[at] == key
        out = []
        for end, k in zip(ends[kept].tolist(), key[kept].tolist(), strict=True):
            start = end - self.m + 1
            out += [(start, i) for i in self.buckets[k] if data.startswith(self.patterns[i], start)]
        return out


def squeezed(texts: list[bytes]) -> np.ndarray:
    """Words of the texts, one space around each; END stands, as a word, before and after each text."""
    raw = np.frombuffer(b"\xff " + b" \xff ".join(x.translate(WORD_BYTES) for x in texts) + b" \xff ", np.uint8)
    gap = raw == 32
    keep = ~gap
    keep[1:] |= gap[1:] & ~gap[:-1]
    return raw[keep]


def scan(texts: list[bytes], searches: list[WuManber], items: list[list[list[int]]]) -> tuple[list[int], list[list[tuple[int, int]]], list[set[int]]]:
    """Of each text: its number of words, the runs of hit words [first, past), the items with occurrences."""
    buf = squeezed(texts)
    space = buf == 32
    starts = np.flatnonzero(space[:-1]) + 1  # a word follows each space but the last
    bounds = np.searchsorted(starts, np.flatnonzero(buf == END)[1:])  # the END that closes each text, as a word
    first = np.concatenate(([0], bounds[:-1] + 1))
    data = b"\x01" * 8 + buf.tobytes()
    runs, found = [[] for _ in texts], [set() for _ in texts]
    for search, owners in zip(searches, items, strict=True):
        for start, i in search.find(data):
            word = int(np.searchsorted(starts, start - 8 + 1))
            doc = int(np.searchsorted(bounds, word))
            runs[doc].append((word - int(first[doc]), word - int(first[doc]) + search.patterns[i].count(b" ") - 1))
            found[doc].update(owners[i])
    return (bounds - first).tolist(), runs, found


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def prepared(rows: list[tuple[str | None, bytes]], window: int) -> tuple[list[WuManber], list[list[list[int]]], list[str | None]]:
    owners: dict[bytes, set[int]] = {}
    for k, (_, text) in enumerate(rows):
        for p in item_patterns(text, window):
            owners.setdefault(p, set()).add(k)
    sides = [[p for p in owners if len(p) < SHORT], [p for p in owners if len(p) >= SHORT]]
    return [WuManber(x) for x in sides if x], [[sorted(owners[p]) for p in x] for x in sides if x], [i for i, _ in rows]


_searches: dict[str, tuple] = {}


def searches_of(key: str, block: Broadcast, window: int) -> tuple[list[WuManber], list[list[list[int]]], list[str | None]]:
    """The tables of a block, kept by the worker process for its later tasks; those of another block go."""
    if key not in _searches:
        _searches.clear()
        _searches[key] = prepared(block.value, window)
    return _searches[key]


HIT = "array<struct<a:bigint,b:bigint>>"
NAMES = ("n_words", "hit_runs", "hit_items")


def hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES, names: tuple[str, str, str] = NAMES) -> DataFrame:
    """docs with three columns more: the number of words long, the hit runs array of [first word, past the last], and the ids of the items with hits, an array of sorted strings.

    ``names`` are their names, which docs must not have (an error tells so).
    """
    if unused(docs, *names) != tuple(names):
        raise ValueError(f"the documents have a column named like one of {names}")
    bench = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).cast("binary").alias("t")).where("t is not null")
    blocks = max(1, math.ceil((bench.agg(F.sum(F.length("t"))).first()[0] or 0) / block_bytes))
    part = lambda k: [(r.i, bytes(r.t)) for r in bench.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).collect()]
    if blocks == 1:
        return searched(docs, part(0), text, window, names)
    h, g, n, runs, items = unused(docs, "h", "g", "n", "runs", "items")
    keys = [F.xxhash64(text).alias(h), F.xxhash64(F.lit(1), text).alias(g)]
    found = []
    for k in range(blocks):
        one = searched(docs.where(F.col(text).isNotNull()).select(text), part(k), text, window, (n, runs, items))
        found.append(saved(one.where(F.size(runs) > 0).select(*keys, runs, items).distinct()))
    every = reduce(DataFrame.unionByName, found).groupBy(h, g).agg(F.flatten(F.collect_list(runs)).alias(runs), F.array_sort(F.array_distinct(F.flatten(F.collect_list(items)))).alias(items))
    counted = searched(docs, [], text, window, names).drop(*names[1:]).withColumns({h: F.xxhash64(text), g: F.xxhash64(F.lit(1), text)})
    joined = counted.join(every, [h, g], "left")
    return joined.select(*docs.columns, names[0], F.coalesce(union_of(F.col(runs)), F.array().cast(HIT)).alias(names[1]), F.coalesce(items, F.array().cast("array<string>")).alias(names[2]))


def union_of(runs: Column) -> Column:
    """Runs that don't touch, from any runs."""
    fold = lambda s, r: F.when((F.size(s) > 0) & (r["a"] <= F.element_at(s, -1)["b"]), F.array_append(F.slice(s, 1, F.size(s) - 1), F.struct(F.element_at(s, -1)["a"].alias("a"), F.greatest(F.element_at(s, -1)["b"], r["b"]).alias("b")))).otherwise(F.array_append(s, r))
    return F.aggregate(F.sort_array(runs), F.array().cast(HIT), fold)


def searched(docs: DataFrame, rows: list[tuple[str | None, bytes]], text: str, window: int, names: tuple[str, str, str]) -> DataFrame:
    """docs with the three columns for one block of items. In one pass, in place."""
    block = docs.sparkSession.sparkContext.broadcast(rows)
    key = uuid.uuid4().hex
    schema = docs.withColumns({names[0]: F.lit(0).cast("long"), names[1]: F.array().cast(HIT), names[2]: F.array().cast("array<string>")}).schema

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches, owners, ids = searches_of(key, block, window)
        for batch, raw in steps(batches, text):
            n, runs, found = scan(raw, searches, owners)
            made = {
                names[0]: pa.array(n, pa.int64()),
                names[1]: pa.array([[{"a": a, "b": b} for a, b in merged(r)] for r in runs], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
                names[2]: pa.array([sorted({ids[i] for i in f if ids[i] is not None}) for f in found], pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays([*batch.columns, *made.values()], names=[*batch.schema.names, *made])

    return docs.mapInArrow(each, schema)


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """A digest row for each document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = hits(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), benchmark, **how)
    n_hit = F.aggregate("hit_runs", F.lit(0).cast("long"), lambda s, r: s + r["b"] - r["a"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "hit_items").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents in which no benchmark window occurs, with their own columns, whatever their names."""
    names = unused(docs, *NAMES)
    return hits(docs, benchmark, names=names, **how).where(F.size(names[1]) == 0).select(*docs.columns)


def sha256_of(ids: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
