"""Connected components by alternating large and small stars, after each task has made stars of the edges that it reads."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.shared import discarded, saved

#: Edges that a task holds at once.
EDGES = 1 << 19


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a long, b long); root is the smallest node it is linked with. Loops and repeated edges do no harm."""
    now = saved(_tidy(_contracted(edges.select("a", "b"))))
    while not _are_stars(now):
        last, now = now, saved(_star(_star(now, large=True), large=False))
        discarded(last)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges that connect the same nodes: of each EDGES that a task reads, stars around their least nodes, so that few rounds are left for the shuffles."""

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        nodes, at = np.unique(np.concatenate((table.column("a").to_numpy(), table.column("b").to_numpy())), return_inverse=True)
        a, b = at[: len(table)], at[len(table) :]
        root, before = np.arange(len(nodes)), None
        while before is None or (root != before).any():
            before = root.copy()
            low = np.minimum(root[a], root[b])
            for side in (before[a], before[b], a, b):
                np.minimum.at(root, side, low)
            root = root[root]
        off = root != np.arange(len(nodes))
        return pa.RecordBatch.from_pydict({"a": pa.array(nodes[off], pa.int64()), "b": pa.array(nodes[root[off]], pa.int64())})

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= EDGES:
                yield stars(held)
                held = []
        if held:
            yield stars(held)

    return edges.where("a <> b").mapInArrow(contract, "a long, b long")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is tied to one smaller node, which is tied to none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    odd = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)")
    return odd.agg(F.count("*")).first()[0] == 0


def _tidy(edges: DataFrame) -> DataFrame:
    """Each edge once, from the greater node to the smaller."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: neighbours greater than a node are tied to the least neighbour. Small: those not greater, and the node itself."""
    seen = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = seen.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = seen.join(least, "a")
    if large:
        return _tidy(joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
    return _tidy(joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))))
