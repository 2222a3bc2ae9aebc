"""MinHash near-duplicate join of documents by chosen paths.

A document's set of word shingles is embedded as ``WIDTH`` minwise tokens; two sets agree in a token with the probability of their Jaccard similarity. The join grows
independent random trees over the documents. A node of a tree selects one or two of the places, by the hash of its path; a document goes to the child (place, token) for each of them,
so similar documents stay together on some path and others part. Each level of all trees is one job:

* A node of up to ``limit`` (2048) documents is compared exhaustively, by its documents' signatures.
* In a greater one all documents are compared with its least document first: those near it are candidates of one group and need no comparison among themselves
  on this path, so that they drop out once a node holds no others. The rest, and what is to be compared with the rest, is branched further.
* A greater node whose documents are on average as near to the least as ``DENSE`` is parted by no path faster than paths multiply: it is compared exhaustively, as one group of candidates.
* What is still great after ``levels`` levels is one group of candidates, whatever it holds, which the last step compares in full.

A pair at the threshold survives in a tree of any depth with probability 0.76 or more at 0.85 (``survival``), so ``trees_for`` gives the number of independent trees that reach the target recall. Candidates (documents whose
signatures agree in so many places that a pair at the threshold has fewer with a probability of 1e-6 only) are confirmed on their full sets, by exact products of the sets of each
candidate component in blocks; nothing is linked on signatures alone.

Documents with one set are one node of the join, by 64 bits of hash. Null text, empty text and text without words have an empty set, linked with nothing. A text of fewer than ``words``
words has one shingle, the whole sequence. Repeated rows and repeated ids are linked as their texts are; null ids stay rows and never name a component unless all its ids are null. An
empty table gives no row. Other columns are ignored by ``classes`` and kept by ``deduplicate``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from reelspark.llm.arrow import mix, steps
from reelspark.llm.components import components
from reelspark.llm.ngram_join import BLOCK, connected
from reelspark.llm.shared import discarded, saved, unused
from reelspark.llm.shingles import set_signature, shingle_sets

WIDTH, LIMIT, LEVELS, RECALL = 128, 2048, 8, 1 - 1e-6
#: Paths multiply by 1.5 at each level, and pairs of this similarity by 0.9.
DENSE = 0.6
#: Odd factors and offsets of the minwise functions: a fixed sequence.
FACTORS = mix(np.arange(1, WIDTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
OFFSETS = mix(np.arange(WIDTH + 1, 2 * WIDTH + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def survival(percent: int) -> float:
    """The least probability, over trees of any depth, that a pair of this similarity meets in a leaf: the fixed point of one or two children (each with probability 1/2), of which the pair shares each with its similarity."""
    t = percent / 100
    return 1.0 if t >= 1 else max(0.0, (1.5 * t - 1) / (0.5 * t * t))


def trees_for(percent: int, recall: float = RECALL) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(max(1 - survival(percent), 1e-9))))


def least_agreement(percent: int, width: int = WIDTH, loss: float = 1e-6) -> int:
    """The number of places in which a pair at the threshold has fewer equal tokens with a probability of ``loss`` at most."""
    t, below = percent / 100, 0.0
    for k in range(width + 1):
        below += math.comb(width, k) * t**k * (1 - t) ** (width - k)
        if below > loss:
            return k
    return width


def minwise_tokens(sets: list[np.ndarray]) -> np.ndarray:
    """A row of WIDTH tokens (32 bits of the smallest value of each function) for each set; sets must not be empty."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets)])[:-1]
    flat = flat ^ (flat >> np.uint64(31))
    out = np.empty((len(sets), WIDTH), np.uint32)
    for k in range(WIDTH):
        out[:, k] = np.minimum.reduceat(flat * FACTORS[k] + OFFSETS[k], starts) >> np.uint64(32)
    return out


def embedded(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n, node (the set's hash; null without words) and tokens (WIDTH times 4 bytes)."""

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in steps(batches, "text"):
            sets = shingle_sets(raw, words)
            there = [x for x in sets if len(x)]
            tokens = iter(minwise_tokens(there)) if there else iter(())
            rows = [(len(x), set_signature(x), next(tokens).tobytes()) if len(x) else (0, None, None) for x in sets]
            n, node, token = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(token, pa.binary())], names=["doc_id", "n", "node", "tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(embed, f"doc_id {kind}, n long, node long, tokens binary")


def signed(nodes: DataFrame) -> DataFrame:
    """nodes with their ``signature``, a byte of each token, which is what leaves are compared by."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield batch.append_column("signature", pa.array([x.tobytes() for x in rows_of(batch.column("tokens")).astype(np.uint8)], pa.binary()))

    return nodes.mapInArrow(sign, StructType([*nodes.schema, StructField("signature", BinaryType())]))


def rows_of(column: pa.Array, kind: type = np.uint32) -> np.ndarray:
    """Rows of WIDTH values from a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, WIDTH)


def selected(path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place of each path, and the second one (the first again where the path selects only one)."""
    h = mix(path.view(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    first = (h % np.uint64(WIDTH)).astype(np.int64)
    step = (1 + (h >> np.uint64(32)) % np.uint64(WIDTH - 1)).astype(np.int64)
    return first, np.where(h >> np.uint64(63) == 1, (first + step) % WIDTH, first)


def children(path: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position of a row, its path below) for each selected place of each row."""
    at = np.arange(len(path))
    below, rows = [], []
    first, second = selected(path)
    for place, which in ((first, at), (second, at[second != first])):
        token = tokens[which, place[which]].astype(np.uint64)
        below.append(mix(path[which].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(token + (place[which].astype(np.uint64) << np.uint64(32)))))
        rows.append(which)
    return np.concatenate(rows), np.concatenate(below).view(np.int64)


def planted(nodes: DataFrame, trees: int) -> DataFrame:
    """path, node of the first level of all trees."""
    roots = mix(np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)).view(np.int64)

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                tokens, node = rows_of(batch.column("tokens")), batch.column("node").to_numpy()
                which, path = children(np.repeat(roots, len(node)), np.tile(tokens, (trees, 1)))
                yield pa.RecordBatch.from_pydict({"path": pa.array(path), "node": pa.array(node[which % len(node)])})

    return nodes.select("node", "tokens").mapInArrow(plant, "path long, node long")


def near(signature: np.ndarray, n: np.ndarray, one: int, least: int, percent: int, among: slice) -> np.ndarray:
    """Which of ``among`` agree with row ``one`` in enough places and are near enough in size. A byte tells places apart well enough: what agrees by chance is confirmed later."""
    sizes = 100 * np.minimum(n[among], n[one]) >= percent * np.maximum(n[among], n[one])
    return sizes & ((signature[among] == signature[one]).sum(1) >= least)


def spanning(node: np.ndarray, label: np.ndarray, n: np.ndarray, signature: np.ndarray, least: int, percent: int) -> list[tuple[int, int]]:
    """Candidate links of one leaf that span what is near in it. Documents of one label are candidates of one group already."""
    group = np.unique(label, return_inverse=True)[1]
    out = []
    for i in range(len(node) - 1):
        for j in (np.flatnonzero(near(signature, n, i, least, percent, slice(i + 1, None)) & (group[i + 1 :] != group[i])) + i + 1).tolist():
            if group[i] != group[j]:
                out.append((int(node[i]), int(node[j])))
                group[group == group[j]] = group[i]
        if (group == group[0]).all():
            break
    return out


def leaf_links(leaves: DataFrame, percent: int) -> DataFrame:
    """(a, b) of each leaf's candidates. leaves: path, node, label, n, signature; the rows of a path, which are few, come together."""
    least = least_agreement(percent)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def taken(table: pa.Table) -> pa.RecordBatch:
            path, node, label, n = (table.column(c).to_numpy() for c in ("path", "node", "label", "n"))
            signature = rows_of(table.column("signature"), np.uint8)
            cuts = [0, *(np.flatnonzero(path[1:] != path[:-1]) + 1).tolist(), len(path)]
            found = [x for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b - a > 1 for x in spanning(node[a:b], label[a:b], n[a:b], signature[a:b], least, percent)]
            return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([*held, batch])
            path = table.column("path").to_numpy()
            whole = int(np.searchsorted(path, path[-1]))  # the last path may go on in the next batch
            if whole:
                yield taken(table.slice(0, whole))
            held = table.slice(whole).combine_chunks().to_batches()
        if held:
            yield taken(pa.Table.from_batches(held))

    dealt = leaves.repartition("path").sortWithinPartitions("path")
    return dealt.mapInArrow(compare, "a long, b long")


def against_the_least(great: DataFrame, percent: int) -> DataFrame:
    """great (path, node, label, n, signature, tokens, pivot, pivot_n, pivot_tokens) with ``same``, the places that agree with the node's pivot, and ``linked``; those near the pivot are linked and get its label."""
    least = least_agreement(percent)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            n, other = batch.column("n").to_numpy(), batch.column("pivot_n").to_numpy()
            same = (rows_of(batch.column("tokens")) == rows_of(batch.column("pivot_tokens"))).sum(1)
            linked = (100 * np.minimum(n, other) >= percent * np.maximum(n, other)) & (same >= least)
            label = np.where(linked, batch.column("pivot").to_numpy(), batch.column("label").to_numpy())
            names = ["path", "node", "n", "signature", "tokens", "pivot"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(label), pa.array(same), pa.array(linked)], names=[*names, "label", "same", "linked"])

    return great.mapInArrow(compare, "path long, node long, n long, signature binary, tokens binary, pivot long, label long, same long, linked boolean")


def branched(rows: DataFrame) -> DataFrame:
    """path, node, label, n, signature, tokens of the next level."""
    names = ["node", "label", "n", "signature", "tokens"]

    def branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                which, path = children(batch.column("path").to_numpy(), rows_of(batch.column("tokens")))
                below = batch.select(names).take(pa.array(which))
                yield pa.RecordBatch.from_arrays([pa.array(path), *below.columns], names=["path", *names])

    return rows.select("path", *names).mapInArrow(branch, "path long, node long, label long, n long, signature binary, tokens binary")


def described(rows: DataFrame, nodes: DataFrame, *columns: str) -> DataFrame:
    """path, node, label and the columns of rows. Rows of the first level have none of them yet: they get what the nodes have, of which only those asked for are moved where they are few."""
    if "label" in rows.columns:
        return rows.select("path", "node", "label", *columns)
    asked = nodes.select("node", *columns)
    if "tokens" in columns:
        asked = asked.join(rows.select("node").distinct(), "node", "left_semi")
    return rows.join(asked, "node").select("path", "node", F.col("node").alias("label"), *columns)


def candidates(nodes: DataFrame, percent: int, trees: int, limit: int = LIMIT, levels: int = LEVELS) -> DataFrame:
    """(a, b) of nodes, some several times, spanning groups that hold all pairs which may be linked. nodes: node, n, tokens, signature.

    The first level has rows of all nodes, which get signatures only where a path has others; what is branched further, little as a rule, takes its tokens along.
    """
    level, found = planted(nodes, trees), []
    for depth in range(levels):
        level = saved(level)
        counts = level.groupBy("path").agg(F.count("*").alias("size"), *([F.min("label").alias("from"), F.max("label").alias("to")] if depth else []))
        sizes = saved(counts.where("size > 1 and `from` < `to`" if depth else "size > 1").select("path", "size"))  # at the root no two documents are in one group
        some = lambda which, *columns: described(level.join(sizes.where(which).select("path"), "path"), nodes, *columns)  # noqa: E731, B023
        found.append(saved(leaf_links(some(f"size <= {limit}", "n", "signature"), percent)))
        great = saved(sizes.where(f"size > {limit}").select("path"))  # saved, as the small tables below: Spark sees that they are small before it deals out the nodes' tokens
        if great.isEmpty():
            break
        if depth == levels - 1:  # as one group each
            whole = level.join(great, "path").select("path", "node")
            found.append(saved(whole.join(whole.groupBy("path").agg(F.min("node").alias("a")), "path").select("a", F.col("node").alias("b")).where("a <> b")))
            break
        # The least document that is in no group on this path yet, or the least of all.
        inside = level.join(great, "path") if depth else saved(level.join(great, "path").withColumn("label", F.col("node")))
        pivots = saved(inside.groupBy("path").agg(F.min(F.struct((F.col("label") != F.col("node")).alias("grouped"), "node"))["node"].alias("pivot")))
        ready = inside.join(pivots.join(nodes.select(F.col("node").alias("pivot"), F.col("n").alias("pivot_n"), F.col("tokens").alias("pivot_tokens")), "pivot"), "path")
        if not depth:  # rows get their pivot before their own tokens: only numbers are dealt by path, of which one may have most rows
            asked = saved(inside.select("node").distinct())
            ready = ready.join(nodes.select("node", "n", "signature", "tokens").join(asked, "node", "left_semi"), "node")
        compared = saved(against_the_least(ready.select("path", "node", "label", "n", "signature", "tokens", "pivot", "pivot_n", "pivot_tokens"), percent))
        means = compared.groupBy("path").agg((F.avg("same") / WIDTH >= DENSE).alias("dense"))
        judged = compared.join(means, "path")
        found.append(judged.where("(linked or dense) and node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")))
        discarded(level)
        level = branched(judged.where("not dense and node <> pivot"))  # the pivot has been compared with all
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, percent: int = 85, recall: float = RECALL, limit: int = LIMIT, levels: int = LEVELS, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id of every document: the smallest doc_id that its links reach."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = saved(embedded(base, words))
    there = rows.where("node is not null")
    nodes = saved(signed(there.groupBy("node").agg(F.any_value("n").alias("n"), F.any_value("tokens").alias("tokens"), F.min("doc_id").alias("least"))))
    pairs = candidates(nodes.drop("least"), percent, trees_for(percent, recall), limit, levels)
    groups = saved(components(pairs).select(F.col("root").alias("pivot"), "node"))
    least = nodes.select("node", "least")
    joined = connected(base, least.select("node", F.xxhash64("least").alias("of")), groups, words, percent, block)
    named = least.join(joined, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    named = saved(named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("node", "component_id"))
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "node").join(named, "node", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``classes`` with ``kept``: whether the document is the one that stays of its component."""
    found = classes(docs, doc_id, text, **how)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", words: int = 5, percent: int = 80, **how) -> DataFrame:
    """One document of each component, the one with the smallest id (of repeated rows, one), with its own columns. Documents with null ids stay."""
    (name,) = unused(docs, "kept")
    kept = classes(docs, doc_id, words=words, percent=percent, **how).where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(name)).distinct()
    known = docs.where(F.col(doc_id).isNotNull()).join(kept, F.col(doc_id) == F.col(name), "left_semi").dropDuplicates([doc_id])
    return known.unionByName(docs.where(F.col(doc_id).isNull()))
