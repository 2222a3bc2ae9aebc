"""Packing token sequences into windows by best-fit decreasing.

A document is its token ids and an end id. A document longer than a window is first cut into full windows, which are sequences of
their own; what is left of it is a tail. Tails are dealt evenly into shards of about ``shard_rows`` documents (more machines take more
shards, and no shard grows with the input). A shard's tails, longest first, each go into the open window with the least room
that still holds it, found in a segment tree over remaining capacity; if there's none, a new window opens.

Null text is empty: only the end id. Repeated rows are packed each for itself. An empty table gives no row. Null ids are kept.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.arrow import steps

WINDOW, END_ID, SHARD_ROWS, CACHE_ENTRIES = 2048, 1, 25_000, 350_000


def pack_ids(*ids: int) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Words(dict):
    """Ids, as little-endian 32-bit numbers, of the pieces between ASCII white space, which the tokenizer drops.

    The tokenizer splits no further than at white space what it then handles apart, so the ids of a text are those of its pieces.
    A piece with letters below U+0180 alone, for which normal form and lower case are simple, is split as the tokenizer splits it, and
    its words go straight to the tokenizer's BPE model; any other piece goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.words: dict[str, bytes] = {}
        # The pre-tokenizer's pattern, for characters below U+0180.
        self.split = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿā-ſ]+|[0-9²³¹¼½¾]|(?:[^\sa-zªµºß-öø-ÿā-ſ0-9²³¹¼½¾]|[\x1c-\x1f])+").findall
        self.plain = re.compile(r"[\x00-įı-ſ]*").fullmatch
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in byte-level BPE
        self.shown = dict(zip([b for b in range(256) if b not in set(shown)], range(256, 512))) | {b: b for b in shown}

    def __missing__(self, piece: bytes) -> bytes:
        s = piece.decode()
        if self.plain(s) and "<|" not in s and len(s) < 200:
            out = b"".join(self.words.get(w) or self._word(w) for w in self.split(s.lower()))
        else:
            out = np.array(self.whole.encode(s, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) < CACHE_ENTRIES:  # what comes often comes early
            self[piece] = out
        return out

    def _word(self, w: str) -> bytes:
        out = pack_ids(*[t.id for t in self.model.tokenize(w.encode().decode("latin-1").translate(self.shown))])
        if len(self.words) < CACHE_ENTRIES:
            self.words[w] = out
        return out

    def ids(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


_words: dict[str, Words] = {}


def words(path: str) -> Words:
    """One for each worker process, whose tasks share what it knows."""
    if path not in _words:
        _words[path] = Words(path)
    return _words[path]


class Room:
    """Open windows by remaining capacity, in a segment tree of counts."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(self.leaves)]

    def put(self, room: int, window: int) -> None:
        self.open[room].append(window)
        self._add(room, 1)

    def _add(self, room: int, n: int) -> None:
        i = room + self.leaves
        while i:
            self.tree[i] += n
            i >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """The window with the least room of at least ``least``, as (room, window)."""
        tree, i = self.tree, least + self.leaves
        while not tree[i]:
            while i & 1:  # no leaf to the right below the parent
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.leaves:
            i = 2 * i + (not tree[2 * i])
        room = i - self.leaves
        self._add(room, -1)
        return room, self.open[room].pop()


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length; lengths must be in falling order."""
    room, n = Room(window), 0
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for k, x in enumerate(lengths.tolist()):
        got = room.take(x)
        left, at = got or (window, n)
        n += got is None
        sequence[k], offset[k] = at, window - left
        if left > x:
            room.put(left - x, at)
    return sequence, offset


def pieces(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of each piece, and with ``with_ids`` its ids (little-endian 32-bit)."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    end = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words(tokenizer_path)
        for batch, raw in steps(batches, "text"):
            row, start, length, crc, total, ids = [], [], [], [], [], []
            for k, x in enumerate(raw):
                got = known.ids(x) + end
                n = len(got) // 4
                for a in range(0, n, window):
                    part = got[4 * a : 4 * min(n, a + window)]
                    row.append(k)
                    start.append(a)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                    if with_ids:
                        ids.append(part)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total)), *([pa.array(ids, pa.binary())] if with_ids else [])], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids])

    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids)


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, shard_rows: int = SHARD_ROWS, **how) -> DataFrame:
    """Pieces with sequence_id and offset. Sequence ids of different shards differ."""
    cut = pieces(docs, tokenizer_path, window=window, **how)
    shards = max(1, -(-docs.count() // shard_rows))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if len(b)]
        if not got:
            return
        table = pa.Table.from_batches(got)
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]).combine_chunks()
        sequence, offset = best_fit(table.column("length").to_numpy(), window)
        sequence += TaskContext.get().partitionId() << 36
        yield from table.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset)).to_batches(max_chunksize=20_000)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    return cut.repartition(shards).mapInArrow(fill, schema)
