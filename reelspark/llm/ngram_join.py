"""Jaccard self-join of documents on word n-grams, by a blocked sparse matrix product.

Documents with one n-gram set are one node. A node's n-grams are put in one global order, rarest first by counters of fixed size over all documents;
two sets that reach the threshold share one of each set's first n - ceil(t n) + 1 (a bound that its size gives). Nodes that share such an n-gram and are
near in size are in one group, named by its least node. A group is dealt by hash into blocks of about ``block`` nodes. A product of two blocks multiplies
the rows of one by the columns of the other: it accumulates the overlap counts of the incidence lists and discards pairs below
ceil(t (|a| + |b|) / (1 + t)), the size-derived bound, which decides exactly. From each product come links that span what it found connected.

1. Each block is multiplied by itself and the group's least node: as many products as blocks, so a group of near copies, however large, costs in proportion to its nodes.
2. What the links connect so far needs no further product among itself. In groups of several blocks, the nodes outside the largest connected part (blocks of them) are
   multiplied by all blocks, so that no link between different parts is lost.

Nodes are known by a 64-bit hash of the set. Null text, empty text and text without words have an empty set, linked with nothing. A text of fewer than
``words`` words has one n-gram, the whole sequence. Repeated rows and repeated ids are linked as their texts are; null ids stay rows and never name a component
unless all ids in it are null. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.arrow import mix, steps
from reelspark.llm.components import components
from reelspark.llm.shared import saved, unused
from reelspark.llm.shingles import set_signature, shingle_sets

COUNTER_BITS, COUNTER_PARTS, BLOCK = 22, 64, 1024
#: Bits of the filter for each node, and the fewest and the most (32 MB) of it: 2 to some power.
BITS_A_NODE, LEAST_BITS, MOST_BITS = 16, 20, 28
BAND = 8  # size classes that one task handles together


def n_gram_counters(docs: DataFrame, words: int) -> np.ndarray:
    """In how many documents n-grams of each of 2^22 hash slots are: 16 MB to the driver, whatever the input. A task counts to 255, which is enough for an order.

    An n-gram is told from its slot's others once it is in more documents than they are together, so with any input the prefixes avoid the n-grams that would make large groups.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTER_BITS, np.int64)
        for _, raw in steps(batches, "text"):
            sets = shingle_sets(raw, words)
            total += np.bincount((np.concatenate(sets) >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), minlength=len(total))
        if total.any():
            salt = int(total.sum()) % 61
            yield pa.RecordBatch.from_pydict({"part": pa.array(range(COUNTER_PARTS), pa.int32()), "salt": pa.array([salt] * COUNTER_PARTS, pa.int32()), "counts": pa.array([np.minimum(x, 255).astype("u1").tobytes() for x in np.split(total, COUNTER_PARTS)], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        one = lambda x: np.frombuffer(x, "u1" if 4 * len(x) * COUNTER_PARTS < 5 << COUNTER_BITS else "<u4")  # noqa: E731  bytes from a task, or sums of them
        total = sum(one(x).astype(np.uint64) for x in table.column("counts").to_pylist())
        return pa.table({"part": table.column("part")[:1], "salt": table.column("salt")[:1], "counts": pa.array([np.minimum(total, 0xFFFFFFFF).astype("<u4").tobytes()], pa.binary())}, schema=table.schema)

    kind = "part int, salt int, counts binary"
    parts = docs.select("text").mapInArrow(count, kind).groupBy("part", "salt").applyInArrow(add, kind).groupBy("part").applyInArrow(add, kind).collect()
    out = np.zeros((COUNTER_PARTS, (1 << COUNTER_BITS) // COUNTER_PARTS), np.uint32)
    for r in parts:
        out[r.part] = np.frombuffer(r.counts, "<u4")
    return out.ravel()


def keyed(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n, node, class (of size), and prefix: the node's rarest n-grams, one of which it shares with any set that reaches the threshold."""
    counters = docs.sparkSession.sparkContext.broadcast(n_gram_counters(docs, words))

    width = class_width(percent)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = counters.value
        for batch, raw in steps(batches, "text"):
            size, node, prefix = [], [], []
            for x in shingle_sets(raw, words):
                n = len(x)
                size.append(n)
                node.append(set_signature(x) if n else None)
                first = n + percent * n // -100 + 1 if n else 0
                prefix.append(x[np.lexsort((x, common[(x >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)]))[:first]].view(np.int64))
            flat = np.concatenate(prefix)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, prefix)]), pa.int32()), pa.array(flat))
            kinds = np.floor(np.log(np.maximum(size, 1)) / width).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(node, pa.int64()), pa.array(kinds), lists], names=["doc_id", "n", "node", "class", "prefix"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(key, f"doc_id {kind}, n long, node long, class int, prefix array<long>")


def class_width(percent: int) -> float:
    """Of size classes, in the logarithm: sizes of linked sets differ by a class at most."""
    return float(np.log(100 / percent) * 1.001) if percent < 100 else 1e-9


def stars(nodes: DataFrame, partitions: int, percent: int) -> DataFrame:
    """(pivot, node): the nodes of each cell, under the least of them. A cell has the nodes with one prefix n-gram and of one or the next smaller
    size class; sizes of linked sets differ by a class at most. A cell counts if one of its nodes has the n-gram in the shorter prefix that the smaller of two linked sets needs.
    Cells of one class with the same least node make one group. Tasks get an n-gram's nodes by bands of classes; a class at a band's end goes to the next band too.
    """

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if len(b)]
        if not got:
            return
        gram, node, n, at, size_class, band = (np.concatenate([b.column(k).to_numpy() for b in got]) for k in ("gram", "node", "n", "at", "class", "band"))
        order = np.argsort(gram, kind="stable")
        again = gram[order][1:] == gram[order][:-1]
        order = order[np.concatenate((again, [False])) | np.concatenate(([False], again))]
        gram, node, n, at, size_class, band = (x[order] for x in (gram, node, n, at, size_class.astype(np.int64), band))
        short = at < n - -(-2 * percent * n // (100 + percent)) + 1
        gram, node, short, n, at, band = (np.concatenate((x, x)) for x in (gram, node, short, n.astype(np.int64), at.astype(np.int64), band))
        own = np.arange(len(gram)) < len(size_class)
        cell = np.concatenate((size_class, size_class + 1))
        order = np.lexsort((node, cell, gram))
        order = order[cell[order] // BAND == band[order]]
        gram, node, short, own, cell, n, at = (x[order] for x in (gram, node, short, own, cell, n, at))
        start = np.flatnonzero(np.concatenate((np.ones(min(1, len(gram)), bool), (gram[1:] != gram[:-1]) | (cell[1:] != cell[:-1]))))
        if not len(start):
            return
        sizes = np.diff(np.concatenate((start, [len(gram)])))
        # A set in the cell has no partner there if, with the smallest set that its size and the cell allow, what follows the n-gram in its order is too little.
        lowest = np.repeat(np.minimum.reduceat(np.where(short, n, np.iinfo(np.int32).max), start), sizes)
        other = np.maximum(np.minimum(lowest, n), -(-percent * n // 100))
        fits = (lowest <= n * 100 // percent) & (n - at >= -(-percent * (n + other) // (100 + percent)))
        has_own, has_next = np.logical_or.reduceat(own, start), np.logical_or.reduceat(~own, start)
        # The pairs of one class are those of the next cell too, if that has sets of its own.
        doubled = np.zeros(len(start), bool)
        doubled[:-1] = ~has_next[:-1] & has_own[1:] & (gram[start][1:] == gram[start][:-1]) & (cell[start][1:] == cell[start][:-1] + 1)
        counts = np.repeat(np.logical_or.reduceat(short & fits, start) & has_own & (np.add.reduceat(fits.astype(np.int64), start) > 1) & ~doubled, sizes) & fits
        least = np.repeat(np.minimum.reduceat(np.where(fits, node, np.iinfo(np.int64).max), start), sizes)
        tied = np.unique(np.stack([least, node], 1)[counts], axis=0)
        for k in range(0, len(tied), 100_000):
            yield pa.RecordBatch.from_pydict({c: pa.array(tied[k : k + 100_000, i]) for i, c in enumerate(("pivot", "node"))})

    band = F.floor(F.col("class") / BAND).cast("int")
    bands = F.when(F.col("class") % BAND == BAND - 1, F.array(band, band + 1)).otherwise(F.array(band))
    rows = nodes.select("node", F.col("n").cast("int").alias("n"), "class", bands.alias("bands"), F.posexplode("prefix").alias("at", "gram"))
    rows = rows.select("gram", "node", "n", "at", "class", F.explode("bands").alias("band"))
    return rows.repartition(partitions, "gram", "band").mapInArrow(tie, "pivot long, node long").distinct()


def membership_filter(nodes: DataFrame) -> np.ndarray:
    """A Bloom filter of (node, of), of 16 bits or more for each of them and 2^28 bits (32 MB) at most. It only spares work; joins decide.

    Its spots go, 4 bytes each, to the tasks that make its parts.
    """
    bits = int(np.clip(np.ceil(np.log2(1 + BITS_A_NODE * nodes.count())), LEAST_BITS, MOST_BITS))
    each = (1 << bits) // COUNTER_PARTS

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots = np.unique(np.concatenate(filter_spots(batch.column("node").to_numpy(), batch.column("of").to_numpy(), bits)))
            cuts = np.searchsorted(spots, np.arange(COUNTER_PARTS + 1) * each)
            rows = [(k, (spots[x:y] - k * each).astype("<u4").tobytes()) for k, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if x < y]
            yield pa.RecordBatch.from_pydict({"part": pa.array([k for k, _ in rows], pa.int32()), "bits": pa.array([x for _, x in rows], pa.binary())})

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x in zip(batch.column("part").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                made.setdefault(k, np.zeros(each, bool))[np.frombuffer(x, "<u4")] = True
        yield pa.RecordBatch.from_pydict({"part": pa.array(list(made), pa.int32()), "bits": pa.array([np.packbits(x).tobytes() for x in made.values()], pa.binary())})

    kind = "part int, bits binary"
    out = np.zeros((COUNTER_PARTS, each // 8), np.uint8)
    for r in nodes.select("node", "of").mapInArrow(spread, kind).repartition(COUNTER_PARTS, "part").mapInArrow(mark, kind).collect():
        out[r.part] = np.frombuffer(r.bits, np.uint8)
    return out.ravel()


def filter_spots(node: np.ndarray, of: np.ndarray, bits: int) -> list[np.ndarray]:
    h = mix(node.view(np.uint64) ^ mix(of.view(np.uint64) + np.uint64(1)))
    return [((h >> np.uint64(k)) & np.uint64((1 << bits) - 1)).astype(np.int64) for k in (0, 18, 36)]


def passing(packed: np.ndarray, node: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which of (node, of) the filter lets through."""
    spots = filter_spots(node, of, int(len(packed) * 8).bit_length() - 1)
    return np.logical_and.reduce([(packed[s >> 3] >> (7 - (s & 7)).astype(np.uint8)) & 1 == 1 for s in spots])


def sets_of(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node and n-grams (sorted 64-bit numbers) of ``nodes`` (node long, of long: the hash of the id of the document to take them from), a row for each."""
    wanted = docs.sparkSession.sparkContext.broadcast(membership_filter(nodes))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch, raw in steps(batches, "text"):
            node, of, grams = [], [], []
            sets = shingle_sets(raw, words)
            known = np.array([set_signature(x) if len(x) else 0 for x in sets], np.int64)
            ids = batch.column("of").to_numpy()
            through = passing(wanted.value, known, ids)
            for k, x in enumerate(sets):
                if len(x) and through[k] and (key := (int(known[k]), int(ids[k]))) not in seen:
                    seen.add(key)  # not the node alone: a copy with another id may pass the filter falsely
                    node.append(key[0])
                    of.append(key[1])
                    grams.append(x.tobytes())
            yield pa.RecordBatch.from_pydict({"node": pa.array(node, pa.int64()), "of": pa.array(of, pa.int64()), "grams": pa.array(grams, pa.binary())})

    found = docs.select(F.xxhash64("doc_id").alias("of"), "text").mapInArrow(emit, "node long, of long, grams binary")
    right = found.join(nodes.select("node", F.col("of").alias("from")), "node").where(F.col("of") == F.col("from"))
    return right.groupBy("node").agg(F.first("grams").alias("grams"))  # repeated rows of a document give its set twice


def block_links(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int, parts: list[int] | None = None) -> list[tuple[int, int]]:
    """Spanning links between positions of left and of right (counted on after left's); right None: within left. parts: of each position, what is connected already.

    The product of left's rows with right's columns: a row's n-grams pick the lists of right's documents that have them, and the lists' counts are the overlaps.
    """
    cols = left if right is None else right
    base = 0 if right is None else len(left)
    sizes = np.array([len(x) for x in cols])
    grams = np.concatenate(cols)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], np.repeat(np.arange(len(cols)), sizes)[order]
    first: dict[int, int] = {}
    parent = list(range(base + len(cols))) if parts is None else [first.setdefault(x, k) for k, x in enumerate(parts)]

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out, apart = [], len(set(parent)) - 1
    for i, row in enumerate(left):
        if not apart:  # all are connected: no further link tells more
            break
        a, b = np.searchsorted(grams, row, "left"), np.searchsorted(grams, row, "right")
        n = b - a
        spots = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
        overlap = np.bincount(owner[spots], minlength=len(cols))
        # overlap / union >= t when overlap (100 + t) >= t (|a| + |b|), in percent
        for j in np.flatnonzero(overlap * (100 + percent) >= percent * (len(row) + sizes)).tolist():
            x, y = root(i), root(base + j)
            if x != y:
                parent[y] = x
                apart -= 1
                out.append((i, base + j))
    return out


def arrays(table: pa.Table, rows: np.ndarray) -> list[np.ndarray]:
    grams = table.column("grams")
    return [np.frombuffer(grams[k].as_py(), np.uint64) for k in rows.tolist()]


def linked_rows(found: list[tuple[int, int]], node: np.ndarray) -> pa.Table:
    return pa.table({"a": pa.array([node[x] for x, _ in found], pa.int64()), "b": pa.array([node[y] for _, y in found], pa.int64())})


def links_to_the_least(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that span what is connected within each block, the group's least node included. members: pivot, node, at, blocks."""
    leads = members.where("node = pivot").select("pivot", "node", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at"))
    asked = members.where("node <> pivot").select("pivot", "node", "at").unionByName(leads)

    def multiply(key: tuple, table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        order = np.argsort(node != key[0].as_py(), kind="stable")  # the least node first: near copies are connected after one row
        return linked_rows(block_links(arrays(table, order), None, percent), node[order])

    return asked.join(sets, "node").groupBy("pivot", "at").applyInArrow(multiply, "a long, b long")


def open_groups(members: DataFrame, parts: DataFrame, block: int) -> DataFrame:
    """pivot, node, at, blocks, root, main, rests: the members of groups of several blocks that parts (node, root) leave in more than one part. main: the root of the largest; the others make ``rests`` blocks."""
    named = members.where("blocks > 1").join(parts, "node", "left").select("pivot", "node", "at", "blocks", F.coalesce("root", "node").alias("root"))
    sizes = named.groupBy("pivot", "root").agg(F.count("*").alias("c"))
    largest = sizes.groupBy("pivot").agg(F.max(F.struct("c", "root"))["root"].alias("main"), F.sum("c").alias("all"), F.max("c").alias("most")).where(F.col("all") > F.col("most"))
    return named.join(largest.select("pivot", "main", F.ceil((F.col("all") - F.col("most")) / block).cast("int").alias("rests")), "pivot")


def links_of_the_rest(still_open: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the parts of open groups: nodes outside a group's largest part against all its nodes of other parts."""
    rest = F.pmod(F.xxhash64(F.lit(1), "node"), "rests").cast("int")
    rows = still_open.where("root <> main").select("pivot", "node", "root", F.lit(True).alias("row"), rest.alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    cols = still_open.select("pivot", "node", "root", F.lit(False).alias("row"), F.explode(F.sequence(F.lit(0), F.col("rests") - 1)).alias("i"), F.col("at").alias("j"))

    def multiply(table: pa.Table) -> pa.Table:
        row = table.column("row").to_numpy(zero_copy_only=False)
        rows, cols = np.flatnonzero(row), np.flatnonzero(~row)
        if not len(rows) or not len(cols):
            return linked_rows([], np.empty(0, np.int64))
        order = np.concatenate((rows, cols))
        return linked_rows(block_links(arrays(table, rows), arrays(table, cols), percent, table.column("root").to_numpy()[order].tolist()), table.column("node").to_numpy()[order])

    return rows.unionByName(cols).join(sets, "node").groupBy("pivot", "i", "j").applyInArrow(multiply, "a long, b long")


def connected(docs: DataFrame, nodes: DataFrame, groups: DataFrame, words: int, percent: int, block: int) -> DataFrame:
    """(node, root) of the nodes that links connect. nodes: node, of (the hash of the id of a document that has the set)."""
    sized = groups.groupBy("pivot").agg(F.count("*").alias("size")).where("size > 1").select("pivot", F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    members = saved(groups.join(sized, "pivot").select("pivot", "node", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("at")))
    sets = lambda of: sets_of(docs, nodes.join(of.select("node").distinct(), "node", "left_semi"), words)
    parts = components(saved(links_to_the_least(members, sets(members), percent)))
    if (rest := saved(open_groups(members, parts, block))).isEmpty():
        return parts
    more = saved(links_of_the_rest(rest, sets(rest), percent))
    return parts if more.isEmpty() else components(parts.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, percent: int = 85, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id of every document: the smallest doc_id that its links reach."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    keys = saved(keyed(base, words, percent))
    nodes = keys.where("node is not null").groupBy("node").agg(*[F.any_value(c).alias(c) for c in ("n", "class", "prefix")])
    partitions = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = saved(stars(nodes, partitions, percent))
    least = keys.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    joined = connected(base, least.select("node", F.xxhash64("least").alias("of")), groups, words, percent, block)
    named = least.join(joined, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    named = saved(named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("node", "component_id"))
    rows = keys.select("doc_id", F.col("n").alias("n_shingles"), "node")
    return rows.join(named, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", words: int = 5, percent: int = 80, block: int = BLOCK, **how) -> DataFrame:
    """One document of each component, the one with the smallest id (of repeated rows, one), with its own columns. Documents with null ids stay."""
    (name,) = unused(docs, "kept")
    kept = classes(docs, doc_id, words=words, percent=percent, block=block, **how).where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(name)).distinct()
    known = docs.where(F.col(doc_id).isNotNull()).join(kept, F.col(doc_id) == F.col(name), "left_semi").dropDuplicates([doc_id])
    return known.unionByName(docs.where(F.col(doc_id).isNull()))
