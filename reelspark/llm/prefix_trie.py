"""The trie of conversation prefixes, by prefix-doubling naming.

A conversation is a sequence of turns. Blocks of 2^k turns that begin at a multiple of 2^k get dense names in one join round for each k: a block's name stands
for the pair of names of its halves, so equal names are equal turns. A prefix of d turns is put together from the blocks of d's binary digits, at most one of
each size, and the rows of one depth with the same names are one node. Rounds grow with the logarithm of the longest conversation.

Sums over a subtree need no walk along it: each node is owned by its smallest member, a conversation's rows add up what it owns from a depth on, and a node's members
add these up.

Null role or text is empty. Turns stand in the order of ``turn`` (null first), turns of one number in the order of their contents' hashes. Rows without a conversation id belong
to no conversation and are left out. Contents are known by SHA-256, so texts of any length are read once and not shuffled. Repeated rows are repeated turns. Other columns are ignored.
An empty table gives no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.shared import discarded, saved
from reelspark.operators.ordered import numbered, sums_from_here

WORD = r"[^\x20\x09-\x0D]+"


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, at (1-based place), digest (32 bytes that stand for role and text), words of the text."""
    says, who = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text, role))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(" "), who, says), 256))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), digest.alias("digest"), F.regexp_count(says, F.lit(WORD)).cast("long").alias("words"))
    return numbered(rows, ["conv_id"], ["turn", "digest"], "at").drop("turn")


def rebuilt(original: DataFrame, apart: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): each conversation c goes on from the first h turns of conversation c - c % ``apart``, in place of its own first h; h is crc32(c) % ``most``.

    ``original`` as from ``turns``, with whole numbers as ids. Conversations (conv_id, size) may be left without turns.
    """
    sizes = original.groupBy("conv_id").agg(F.count("*").alias("own"))
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("head")
    asked = sizes.select("conv_id", "own", head, (F.col("conv_id") - F.col("conv_id") % apart).alias("donor"))
    donors = sizes.select(F.col("conv_id").alias("donor"), F.least("own", F.lit(most - 1)).alias("there"))
    known = saved(asked.join(donors, "donor", "left").withColumn("taken", F.least("head", F.coalesce("there", F.lit(0)))))
    heads = original.where(F.col("at") < most).withColumnRenamed("conv_id", "donor")
    given = known.where("taken > 0").select("conv_id", "donor", "taken").join(heads, "donor").where("at <= taken").select("conv_id", "at", "digest", "words")
    kept = original.join(known.select("conv_id", "head", "taken"), "conv_id").where("at > head").select("conv_id", (F.col("at") - F.col("head") + F.col("taken")).alias("at"), "digest", "words")
    size = F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0))
    return given.unionByName(kept), known.select("conv_id", size.cast("long").alias("size"))


def dense(values: DataFrame) -> DataFrame:
    """values with ``name``: 0, 1, 2, ... without gaps. The rows are saved with their places in the tasks that wrote them; only the tasks' counts go to the driver."""
    seats = saved(values.withColumn("seat", F.monotonically_increasing_id()))
    counts = seats.groupBy(F.shiftrightunsigned("seat", 33).alias("piece")).agg(F.count("*").alias("n")).collect()
    before, offsets = 0, []
    for r in sorted(counts):
        offsets.append((r.piece, before))
        before += r.n
    first = F.broadcast(values.sparkSession.createDataFrame(offsets, "piece long, before long"))
    placed = seats.withColumn("piece", F.shiftrightunsigned("seat", 33)).join(first, "piece")
    return placed.withColumn("name", F.col("before") + F.col("seat").bitwiseAND(F.lit((1 << 33) - 1))).drop("piece", "before", "seat")


def block_names(rows: DataFrame, longest: int) -> DataFrame:
    """conv_id, k, j, name of each whole block of 2^k turns from turn j 2^k (counted from 0) on."""
    contents = dense(rows.select("digest").distinct())
    level = saved(rows.join(contents, "digest").select("conv_id", (F.col("at") - 1).alias("j"), "name"))
    out = level.withColumn("k", F.lit(0))
    for k in range(1, longest.bit_length()):
        left = level.where("j % 2 = 0").select("conv_id", F.expr("j div 2").alias("j"), F.col("name").alias("left"))
        right = level.where("j % 2 = 1").select("conv_id", F.expr("j div 2").alias("j"), F.col("name").alias("right"))
        pairs = saved(left.join(right, ["conv_id", "j"]))
        level = saved(pairs.join(dense(pairs.select("left", "right").distinct()), ["left", "right"]).select("conv_id", "j", "name"))
        discarded(pairs)
        out = out.unionByName(level.withColumn("k", F.lit(k)))
    return out


def prefixes(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv_id, depth, key, words (of the last turn), ends (whether the conversation has no further turn): a row for each conversation and prefix of it, the empty one too."""
    longest = conversations.agg(F.max("size")).first()[0] or 0
    names = block_names(rows, longest)
    # The digits of d from the highest on: the block of digit k begins where the higher digits end.
    k = F.explode(F.filter(F.sequence(F.lit(0), F.lit(max(0, longest.bit_length() - 1))), lambda k: F.expr("at").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), k)) != 0))
    asked = rows.select("conv_id", "at", "words", k.alias("k"))
    asked = asked.withColumn("j", F.expr("shiftright(at, k + 1) * 2"))
    parts = asked.join(names, ["conv_id", "k", "j"]).groupBy("conv_id", "at").agg(F.max("words").alias("words"), F.sort_array(F.collect_list(F.struct("k", "name"))).alias("parts"))
    key = F.transform("parts", lambda x: x["name"]).alias("key")
    whole = parts.select("conv_id", F.col("at").alias("depth"), key, "words").join(conversations, "conv_id").withColumn("ends", F.col("depth") == F.col("size")).drop("size")
    root = conversations.select("conv_id", F.lit(0).cast("long").alias("depth"), F.array().cast("array<long>").alias("key"), F.lit(0).cast("long").alias("words"), (F.col("size") == 0).alias("ends"))
    return whole.unionByName(root)


def listed_ids(ends: DataFrame) -> DataFrame:
    """depth, conv_id, ends_sha256 of (depth, conv_id, member): the SHA-256 of each node's members in ascending order, comma-joined.

    Members are sorted by range and joined to chunks first; a node's chunks, in order, go through one hash, a batch at a time, so that no list is ever whole in memory.
    """
    kind = ends.schema["member"].dataType.simpleString()

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = []
            for depth, conv, member in zip(*(batch.column(c).to_pylist() for c in ("depth", "conv_id", "member")), strict=True):
                if not out or out[-1][:2] != [depth, conv]:
                    out.append([depth, conv, member, []])
                out[-1][3].append(str(member))
            depths, convs, firsts, lists = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(depths, pa.int64()), pa.array(convs, batch.schema.field("conv_id").type), pa.array(firsts, batch.schema.field("member").type), pa.array([",".join(x) for x in lists], pa.string())], names=["depth", "conv_id", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running, done, kinds = None, None, [], None

        def taken() -> pa.RecordBatch:
            rows = done[:]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0][0] for r in rows], pa.int64()), pa.array([r[0][1] for r in rows], kinds), pa.array([r[1] for r in rows], pa.string())], names=["depth", "conv_id", "ends_sha256"])

        for batch in batches:
            kinds = batch.schema.field("conv_id").type
            for depth, conv, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "conv_id", "ids")), strict=True):
                if (depth, conv) == node:
                    running.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((node, running.hexdigest()))
                node, running = (depth, conv), hashlib.sha256(ids.encode())
            yield taken()
        if node is not None:
            done.append((node, running.hexdigest()))
            yield taken()

    order = ["depth", "conv_id", "member"]
    chunks = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(chunk, f"depth long, conv_id {kind}, first {kind}, ids string")
    return chunks.repartition("depth", "conv_id").sortWithinPartitions("depth", "conv_id", "first").mapInArrow(digest, f"depth long, conv_id {kind}, ends_sha256 string")


def nodes(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: a row for each node.

    rows: conv_id, at, digest, words, as from ``turns``. conversations: conv_id, size; those without turns are members of the root alone.
    """
    every = saved(prefixes(rows, conversations))
    at_node = ["depth", "key"]
    found = saved(every.groupBy(*at_node).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"), F.bool_and("ends").alias("childless")))
    owned = found.select("conv_id", "depth", F.col("childless").cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("spared"))
    weighed = every.select("conv_id", *at_node).join(owned, ["conv_id", "depth"], "left").fillna(0, ["leaf", "spared"])
    below = sums_from_here(weighed, ["conv_id"], "depth", {"n_leaves": "leaf", "saved_tokens": "spared"})
    sums = below.groupBy(*at_node).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    # A node's parent is the prefix of one turn less that the node's smallest member has.
    up = found.where("depth > 0").select("conv_id", "depth", (F.col("depth") - 1).alias("above"))
    lookup = every.select("conv_id", F.col("depth").alias("above"), F.col("key").alias("above_key"))
    placed = saved(up.join(lookup, ["conv_id", "above"]))
    parents = found.select(F.col("depth").alias("above"), F.col("key").alias("above_key"), F.col("conv_id").alias("parent_conv_id"))
    parents = placed.join(parents, ["above", "above_key"]).select("conv_id", "depth", "parent_conv_id")
    children = placed.groupBy(F.col("above").alias("depth"), F.col("above_key").alias("key")).agg(F.count("*").alias("n_children"))
    ends = listed_ids(every.where("ends").select(*at_node, F.col("conv_id").alias("member")).join(found.select(*at_node, "conv_id"), at_node).select("depth", "conv_id", "member"))
    out = found.select(*at_node, "conv_id", "n_convs").join(sums, at_node).join(children, at_node, "left").join(parents, ["conv_id", "depth"], "left").join(ends, ["conv_id", "depth"], "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))


def trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """The nodes of the trie of whole conversations, as ``nodes`` gives them. columns: names for ``turns``."""
    rows = saved(turns(conversations, **columns))
    return nodes(rows, rows.groupBy("conv_id").agg(F.count("*").alias("size")))


def report(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of the conversations that ``rebuilt`` makes."""
    rows, known = rebuilt(saved(turns(conversations)))
    return nodes(saved(rows), known)
