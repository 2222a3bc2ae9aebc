"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelspark.llm.shared import saved


def held_out(doc_id: str, of: int, fold: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % of == fold


def labelled_documents(docs: DataFrame, labels: DataFrame, label: str, of: int, fold: int, each: int) -> DataFrame:
    """text and label of documents that are not held out; at most ``each`` ids of each label value 0 and 1, chosen by hash.

    The ids, at most 2 x ``each``, are broadcast: the texts of all documents are not shuffled for a few. Null ids and labels aren't learned from.
    The rows are saved, so that the documents are read once for them.
    """
    known = labels.select("doc_id", F.col(label).alias("_label")).where(f"doc_id is not null and _label in (0, 1)").where(~held_out("doc_id", of, fold))
    ids = [known.where(F.col("_label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(each) for y in (0, 1)]
    chosen = ids[0].unionByName(ids[1])
    return saved(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", F.col("_label").alias(label)))


def thinned(rows: DataFrame, column: str, n: int) -> DataFrame:
    """About 2 x ``n`` of the rows (all, if there are fewer), by the hash of ``column``, so that a sorted limit of n gathers no more than that from all tasks together."""
    share = min(1.0, 2 * n / max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64(F.lit(1), column), F.lit(1_000_000)) <= int(1_000_000 * share))
