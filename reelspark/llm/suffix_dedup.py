"""Exact removal of repeated byte strings by a distributed difference cover.

Two equal strings of ``length`` bytes at positions i and j share a sampled offset d < v: with a difference cover D modulo v, (i + d) and (j + d) are both
in D modulo v, whatever i and j are. So only sampled positions are compared first:

1. Windowed minima of 64-byte hashes (12 in 1000 positions) drop text that can't repeat: what is left are slices, stretches in which
   each window has a minimum that is found elsewhere too. Nothing repeated is lost.
2. In slices, sampled positions get a triple: the names (hashes) of three blocks, which together cover the least that equal strings share behind a sampled
   offset; and, recursing on names, the name of the whole context, from v - 1 bytes before to ``length`` behind. Tasks sort their range of triples and compare
   neighbours. A repeated context settles all its strings at once; a repeated triple alone leaves v strings open.
3. These remaining suffixes are merged: their prefixes of ``length`` bytes are named, sorted, and compared with their neighbours.

Sorting is by names dealt to tasks by their value, so that a task holds a range of the sorted order and equal names meet; only equality of prefixes is asked
for, so names are hashes and no ranks are passed on, and ``length`` bounds the recursion to one level. What is removed rests on hashes of 64 bits with seeds drawn for each job, which no text can be made to
defeat: two of a string, or one of a triple and one of the context around it. Different strings, and different contexts of one triple, are taken for equal with a probability of about 2^-128 and 2^-64 a pair. Before items are dealt, those of one outbox that have equal names are settled there, and one goes on for all: a name that is in very many texts costs a task that sorts
it some rows for each outbox and not one for each text.

Texts are known by 128 bits of hash; copies of a text count, but only one of them is compared. A text that another row has too is removed whole if it has ``length``
bytes. Null text is empty: nothing is removed. Null ids and repeated ids are kept as rows. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from reelspark.llm.arrow import mix, run_names, steps
from reelspark.llm.shared import discarded, saved, unused

LENGTH = 400
PERIOD = 91
#: Residues whose differences are all residues modulo 91.
COVER = (0, 1, 6, 10, 23, 26, 34, 41, 53, 55)
GRAM, WINDOW = 64, 128


def cover_positions(n: int) -> np.ndarray:
    """Sampled positions below n."""
    if n <= 0:
        return np.empty(0, np.int64)
    whole = np.add.outer(np.arange(0, n, PERIOD), np.array(COVER)).ravel()
    return whole[whole < n]


def window_minima(h: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the smallest value of some ``width`` consecutive ones (of equal ones, all)."""
    if len(h) < width:
        return np.empty(0, np.int64)
    low, n = h, 1
    while 2 * n <= width:
        low = np.minimum(low[:-n], low[n:])
        n *= 2
    if n < width:
        low = np.minimum(low[: len(low) - (width - n)], low[width - n :])
    # the greatest of the minima of the windows that hold a position; it is one of them if it is as great
    high, n = np.concatenate((np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64))), 1
    while 2 * n <= width:
        high = np.maximum(high[:-n], high[n:])
        n *= 2
    if n < width:
        high = np.maximum(high[: len(high) - (width - n)], high[width - n :])
    return np.flatnonzero(h == high[: len(h)])


def byte_hashes(data: bytes, width: int, seed: int) -> np.ndarray:
    return mix(run_names(np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1), width, seed)) if len(data) >= width else np.empty(0, np.uint64)


def drawn() -> int:
    """A seed for the names of one job. The driver draws it, so tasks that are run again use the same."""
    return secrets.randbits(62)


def dealt(part: np.ndarray, names: np.ndarray, which: np.ndarray, table: np.ndarray, sure: bool, *more: np.ndarray) -> pa.RecordBatch:
    """One row for each part and its items. ``which`` points into ``table``. Of sure items nothing is to be compared any more."""
    order = np.argsort(part, kind="stable")
    values, cuts = np.unique(part[order], return_index=True)
    rows = [(int(k), order[a:b]) for k, a, b in zip(values, cuts, [*cuts[1:], len(order)], strict=True)]
    out = {"part": pa.array([k for k, _ in rows], pa.int32()), "sure": pa.array([sure] * len(rows)), "names": pa.array([names[o].tobytes() for _, o in rows], pa.binary())}
    tables, points = [], []
    for _, o in rows:
        used, at = np.unique(which[o], return_inverse=True)
        tables.append(table[used].tobytes())
        points.append(at.astype("<u2" if len(used) < 65_536 else "<u4").tobytes())
    out |= {"docs": pa.array(tables, pa.binary()), "which": pa.array(points, pa.binary())}
    out |= {f"x{i}": pa.array([x[o].tobytes() for _, o in rows], pa.binary()) for i, x in enumerate(more)}
    return pa.RecordBatch.from_pydict(out)


def range_of(names: np.ndarray, parts: int) -> np.ndarray:
    return ((names >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)


class Outbox:
    """Items of several steps, dealt together, so that a part's share of them is worth a row.

    settle(names, more): positions of the items to compare elsewhere, a flag byte for each of them, positions of those that are sure, and a status byte for each. None: all are to be compared.
    """

    def __init__(self, parts: int, settle=None, most: int = 500_000):
        self.parts, self.settle, self.most = parts, settle, most
        self.clear()

    def clear(self) -> None:
        self.table: list[tuple[int, ...]] = []
        self.names: list[np.ndarray] = []
        self.which: list[np.ndarray] = []
        self.more: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def put(self, document: tuple[int, ...], names: np.ndarray, *more: np.ndarray) -> None:
        if len(names):
            self.names.append(names)
            self.which.append(np.full(len(names), len(self.table)))
            self.more.append(more)
            self.table.append(document)
            self.size += len(names)

    def taken(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        """Batches when there is enough, or what is left."""
        if self.size >= self.most or last and self.size:
            names, which, table = np.concatenate(self.names), np.concatenate(self.which), np.array(self.table, np.int64)
            more = [np.concatenate(x) for x in zip(*self.more, strict=True)]
            self.clear()
            if self.settle is None:
                yield dealt(range_of(names, self.parts), names, which, table, False, *more)
                return
            out, flags, sure, status = self.settle(names, more)
            yield dealt(range_of(names[out], self.parts), names[out], which[out], table, False, *[x[out] for x in more], flags)
            if len(sure):
                spread = (np.arange(len(sure)) // 20_000 + int(names[0] >> np.uint64(33))) % self.parts
                yield dealt(spread, np.zeros(len(sure), np.uint64), which[sure], table, True, *[x[sure] for x in more], status)


MOST_ITEMS, CONTEXTS = 500_000, 4


def settled_names(names: np.ndarray, more: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Of equal names (and equal 64-bit ``more[0]``, if it has that type), one goes on, flagged if there are others; the others are sure."""
    second = more[0] if more[0].dtype == np.uint64 else np.zeros(len(names), np.uint64)
    order = np.lexsort((second, names))
    again = (names[order][1:] == names[order][:-1]) & (second[order][1:] == second[order][:-1])
    fresh, same = np.concatenate(([True], ~again)), np.concatenate((again, [False])) | np.concatenate(([False], again))
    sure = order[~fresh]
    return order[fresh], same[fresh].astype("u1"), sure, np.ones(len(sure), "u1")


WHOLE, TRIED, TWICE, MIXED = 1, 2, 4, 8


def settled_triples(names: np.ndarray, more: list[np.ndarray], contexts: int = CONTEXTS) -> tuple[np.ndarray, ...]:
    """Of a triple in several places, one goes on for each context, of ``contexts`` contexts at most. The others of a context are whole; the first of a further context is to be tried."""
    full = more[0]
    order = np.lexsort((full, names))
    n, f = names[order], full[order]
    new_name = np.concatenate(([True], n[1:] != n[:-1]))
    fresh = new_name | np.concatenate(([True], f[1:] != f[:-1])) | (f == 0)
    start = np.flatnonzero(new_name)
    of = np.cumsum(new_name) - 1  # the item's triple
    rank = np.cumsum(fresh) - 1
    rank = rank - rank[start][of]
    begins = np.flatnonzero(fresh)
    shared = (np.diff(np.append(begins, len(n))) > 1)[np.cumsum(fresh) - 1]  # contexts that are there twice
    twice = (np.diff(np.append(start, len(n))) > 1)[of]
    mixed = np.logical_or.reduceat(fresh & (rank >= contexts), start)[of]
    out = fresh & (rank < contexts)
    flags = WHOLE * shared + TWICE * twice + MIXED * mixed
    status = np.where(fresh, TRIED + WHOLE * shared, WHOLE)
    return order[out], flags[out].astype("u1"), order[~out], status[~out].astype("u1")


def kind_of(more: int) -> str:
    return "part int, sure boolean, names binary, docs binary, which binary" + "".join(f", x{i} binary" for i in range(more))


def gathered(batches: Iterator[pa.RecordBatch], width: int, *types: str) -> tuple[list[np.ndarray] | None, list[np.ndarray] | None]:
    """All items of a task, those to compare and those that are sure: names, documents (``width`` longs each), and the other columns."""
    out = []
    kept: tuple[list, list] = ([], [])
    for b in batches:
        for r in b.to_pylist():
            table = np.frombuffer(r["docs"], np.int64).reshape(-1, width)
            docs = table[np.frombuffer(r["which"], "<u2" if len(table) < 65_536 else "<u4")]
            kept[r["sure"]].append([np.frombuffer(r["names"], np.uint64), docs, *[np.frombuffer(r[f"x{i}"], t) for i, t in enumerate(types)]])
    for rows in kept:
        out.append([np.concatenate(x) for x in zip(*rows, strict=True)] if rows else None)
    return tuple(out)


def repeated(*sorted_names: np.ndarray) -> np.ndarray:
    """Which of sorted names (equal in all arrays) equal a neighbour."""
    same = np.logical_and.reduce([x[1:] == x[:-1] for x in sorted_names])
    return np.concatenate((same, [False])) | np.concatenate(([False], same))


def found(docs: np.ndarray, **columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(docs), 200_000):
        yield pa.RecordBatch.from_pydict({k: pa.array(docs[a : a + 200_000, i]) for i, k in enumerate(("h", "g", "start"))} | {k: pa.array(x[a : a + 200_000]) for k, x in columns.items()})


def regrouped(items: DataFrame, parts: int) -> DataFrame:
    """Each part's rows in one task, a few parts for each."""
    return items.repartition(max(1, parts // 4), "part")


def common_minima(texts: DataFrame, parts: int, length: int) -> DataFrame:
    """(h, g, start = 0, at) of window minima whose hash is found twice or more."""
    most, seed = MOST_ITEMS, drawn()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        out = Outbox(parts, settled_names, most)
        for batch, raw in steps(batches, "text"):
            for h, g, x in zip(batch.column("h").to_pylist(), batch.column("g").to_pylist(), raw, strict=True):
                if len(x) >= length and (h, g) not in seen:
                    seen.add((h, g))
                    hashes = byte_hashes(x, GRAM, seed)
                    spots = window_minima(hashes, WINDOW)
                    out.put((h, g, 0), mix(hashes[spots] + np.uint64(1)), spots.astype("<u4"))  # minima are small; spread them over the range
                    yield from out.taken()
        yield from out.taken(True)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, sure = gathered(batches, 3, "<u4", "u1")
        if got is not None:
            names, docs, at, flags = got
            order = np.argsort(names, kind="stable")
            kept = order[repeated(names[order]) | (flags[order] > 0)]
            yield from found(docs[kept], at=at[kept].astype(np.int64))
        if sure is not None:
            yield from found(sure[1], at=sure[2].astype(np.int64))

    return regrouped(texts.select("h", "g", "text").mapInArrow(emit, kind_of(2)), parts).mapInArrow(compare, "h long, g long, start long, at long")


def slices(texts: DataFrame, firsts: DataFrame, minima: DataFrame, length: int) -> DataFrame:
    """(h, g, start, bytes) of the stretches that may hold repeated strings."""
    chosen = minima.groupBy("h", "g").agg(F.collect_list("at").alias("at")).join(firsts, ["h", "g"]).select("h", "g", F.col("doc_id").alias("first"), "at")
    joined = texts.join(chosen, ["h", "g"]).where(F.col("doc_id").eqNullSafe(F.col("first"))).select("h", "g", "doc_id", "text", "at")
    once = joined.dropDuplicates(["h", "g", "doc_id"]).select("h", "g", "text", "at")
    # A string of length bytes holds minima up to WINDOW - 1 behind its start and length - GRAM - WINDOW + 1 or more behind it, and gaps of WINDOW at most between.
    tail, reach = length - GRAM - WINDOW + 1, WINDOW - 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in steps(batches, "text"):
            h, g, start, data = [], [], [], []
            lists = batch.column("at")
            for k, x in enumerate(raw):
                at = np.unique(np.array(lists[k].values.to_numpy(zero_copy_only=False)))
                breaks = np.flatnonzero(np.diff(at) > WINDOW) + 1
                for run in np.split(at, breaks):
                    if run[-1] - run[0] >= tail - reach:
                        a = max(0, int(run[0]) - reach)
                        h.append(batch.column("h")[k].as_py())
                        g.append(batch.column("g")[k].as_py())
                        start.append(a)
                        data.append(x[a : int(run[-1]) - tail + length])
            yield pa.RecordBatch.from_pydict({"h": pa.array(h, pa.int64()), "g": pa.array(g, pa.int64()), "start": pa.array(start, pa.int64()), "data": pa.array(data, pa.binary())})

    return once.mapInArrow(cut, "h long, g long, start long, data binary")


def triples(cuts: DataFrame, parts: int, length: int) -> DataFrame:
    """(h, g, start, at, whole, tried) of sampled positions whose triple is found again. whole: the context too, which settles the strings around it. tried: their strings
    are to be compared: those of positions that aren't whole and, where a triple has such, of one position for each repeated context, for the others to be found by."""
    most, contexts, seed, other = MOST_ITEMS, CONTEXTS, drawn(), drawn()
    least = length - PERIOD + 1
    block = least // 3
    context = length + PERIOD - 1

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Outbox(parts, partial(settled_triples, contexts=contexts), most)
        for batch, raw in steps(batches, "data"):
            for *slice_, x in zip(*(batch.column(c).to_pylist() for c in ("h", "g", "start")), raw, strict=True):
                spots = cover_positions(len(x) - least + 1)
                blocks = byte_hashes(x, block, seed)
                first, second, third = (blocks[spots + k * block] for k in range(3))
                names = mix(first * np.uint64(3) + mix(second * np.uint64(5) + mix(third + np.uint64(1))))
                wide = byte_hashes(x, context, other)
                inside = (spots >= PERIOD - 1) & (spots - (PERIOD - 1) < len(wide))
                full = np.zeros(len(spots), np.uint64)
                full[inside] = wide[spots[inside] - (PERIOD - 1)]
                out.put(tuple(slice_), names, full, spots.astype("<u4"))
                yield from out.taken()
        yield from out.taken(True)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, sure = gathered(batches, 3, "<u8", "<u4", "u1")
        if got is not None:
            names, docs, full, at, flags = got
            order = np.lexsort((full, names))
            names, full, flags = names[order], full[order], flags[order]
            twice, whole = repeated(names) | (flags & TWICE > 0), (repeated(names, full) & (full != 0)) | (flags & WHOLE > 0)
            new_name = np.concatenate(([True], names[1:] != names[:-1]))
            start = np.flatnonzero(new_name)
            mixed = np.repeat(np.logical_or.reduceat(~whole | (flags & MIXED > 0), start), np.diff(np.append(start, len(names))))
            first = new_name | np.concatenate(([True], full[1:] != full[:-1]))
            tried = twice & mixed & (~whole | first)
            kept = tried | (twice & whole)
            yield from found(docs[order[kept]], at=at[order[kept]].astype(np.int64), whole=whole[kept], tried=tried[kept])
        if sure is not None:
            yield from found(sure[1], at=sure[3].astype(np.int64), whole=sure[4] & WHOLE > 0, tried=sure[4] & TRIED > 0)

    return regrouped(cuts.mapInArrow(emit, kind_of(3)), parts).mapInArrow(compare, "h long, g long, start long, at long, whole boolean, tried boolean")


def merged_suffixes(cuts: DataFrame, sampled: DataFrame, parts: int, length: int) -> DataFrame:
    """(h, g, start, at): of the strings that sampled positions leave open, those that are found again."""
    most, seed, other = MOST_ITEMS, drawn(), drawn()
    open_ones = sampled.where("tried").groupBy("h", "g", "start").agg(F.collect_list("at").alias("at"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Outbox(parts, settled_names, most)
        for batch, raw in steps(batches, "data"):
            tried = batch.column("at")
            for k, (*slice_, x) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("h", "g", "start")), raw, strict=True)):
                hashes, others = byte_hashes(x, length, seed), byte_hashes(x, length, other)
                change = np.zeros(len(x) + 2, np.int32)  # a sampled position stands for the strings that start up to v - 1 before it
                p = np.array(tried[k].values.to_numpy(zero_copy_only=False), np.int64)
                np.add.at(change, np.maximum(p - (PERIOD - 1), 0), 1)
                np.add.at(change, p + 1, -1)
                spots = np.flatnonzero(np.cumsum(change)[: len(hashes)] > 0)
                out.put(tuple(slice_), hashes[spots], others[spots], spots.astype("<u4"))
                yield from out.taken()
        yield from out.taken(True)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, sure = gathered(batches, 3, "<u8", "<u4", "u1")
        if got is not None:
            names, docs, others, at, flags = got
            order = np.lexsort((others, names))
            kept = order[repeated(names[order], others[order]) | (flags[order] > 0)]
            yield from found(docs[kept], at=at[kept].astype(np.int64))
        if sure is not None:
            yield from found(sure[1], at=sure[3].astype(np.int64))

    joined = cuts.join(open_ones, ["h", "g", "start"]).select("h", "g", "start", "data", "at")
    return regrouped(joined.mapInArrow(emit, kind_of(3)), parts).mapInArrow(compare, "h long, g long, start long, at long")


def text_hash(text: Column, seed: int = 0) -> Column:
    """64 bits of a text's hash; another seed gives 64 others."""
    raw = F.coalesce(text, F.lit("")).cast("binary")
    return F.xxhash64(F.lit(seed), raw) if seed else F.xxhash64(raw)


def removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """h and g (the text's hash), copies (rows that have it) and spans: array of [first, past the last) removed bytes that don't touch, ascending. length: 191 bytes or more, which the windowed minima need."""
    if length < GRAM + WINDOW - 1:
        raise ValueError(f"length must be {GRAM + WINDOW - 1} or more")
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), text_hash(F.col(text)).alias("h"), text_hash(F.col(text), 1).alias("g"))
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # several for each task, to even them out
    firsts = base.where(F.octet_length("text") >= length).groupBy("h", "g").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    cuts = saved(slices(base, firsts, common_minima(base, parts, length), length))
    sampled = saved(triples(cuts, parts, length))
    settled = sampled.where("whole").select("h", "g", (F.col("start") + F.col("at") - (PERIOD - 1)).alias("a"), (F.col("start") + F.col("at") + length).alias("b"))
    others = merged_suffixes(cuts, sampled, parts, length).select("h", "g", (F.col("start") + F.col("at")).alias("a"), (F.col("start") + F.col("at") + length).alias("b"))
    # Strings that start within fewer bytes than each has overlap: their union is from the first to the last.
    joined = settled.unionByName(others).groupBy("h", "g", F.expr(f"a div {length // 2}").alias("near")).agg(F.min("a").alias("a"), F.max("b").alias("b"))
    spans = saved(joined.groupBy("h", "g").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans")))
    discarded(cuts)
    discarded(sampled)
    copied = firsts.select("h", "g", "copies").where("copies > 1")
    return copied.join(spans, ["h", "g"], "full_outer").select("h", "g", F.coalesce("copies", F.lit(1)).alias("copies"), "spans")


def cut_text(data: bytes, copies: int, spans: list[dict], length: int = LENGTH) -> tuple[bytes, int, int]:
    """What is kept, how many bytes are removed, in how many runs."""
    if copies > 1 and len(data) >= length:
        return b"", len(data), 1
    keep, at, runs, gone = [], 0, 0, 0
    last = -1
    for s in spans:
        a, b = s["a"], s["b"]
        if a > last:  # else it goes on from the one before
            keep.append(data[at:a])
            runs += 1
            gone += b - a
            last = at = b
        elif b > last:
            gone += b - last
            last = at = b
    keep.append(data[at:])
    return b"".join(keep), gone, runs


def applied(docs: DataFrame, doc_id: str, text: str, length: int) -> tuple[DataFrame, str, str]:
    """docs with the two columns that ``cut_text`` takes, and the names of these, which docs lack."""
    h, g, copies, spans = unused(docs, "h", "g", "copies", "spans")
    marks = removed(docs, doc_id, text, length).toDF(h, g, copies, spans)
    keyed = docs.withColumns({h: text_hash(F.col(text)), g: text_hash(F.col(text), 1)})
    return keyed.join(marks, [h, g], "left").drop(h, g), copies, spans


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ready, copies, spans = applied(base, "doc_id", "text", length)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in steps(batches, "text"):
            rows = [(len(x), cut_text(x, c or 1, s or [], length)) for x, c, s in zip(raw, batch.column(copies).to_pylist(), batch.column(spans).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([n for n, _ in rows], pa.int64()), pa.array([r[1] for _, r in rows], pa.int64()), pa.array([r[2] for _, r in rows], pa.int64()), pa.array([hashlib.sha256(r[0]).hexdigest() for _, r in rows])], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = [base.schema["doc_id"], *(StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")), StructField("kept_sha256", StringType())]
    return ready.mapInArrow(digest, StructType(kind))


def clean(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """docs with the repeated bytes cut from their texts; characters that a cut leaves incomplete go too. Null text stays null."""
    names = docs.columns
    ready, copies, spans = applied(docs, doc_id, text, length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in steps(batches, text):
            there = batch.column(text).is_valid().to_pylist()
            fresh = [cut_text(x, c or 1, s or [], length)[0].decode("utf-8", "ignore") if t else None for t, x, c, s in zip(there, raw, batch.column(copies).to_pylist(), batch.column(spans).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(fresh, pa.string()) if n == text else batch.column(n) for n in names], names=names)

    return ready.mapInArrow(cut, docs.schema)
