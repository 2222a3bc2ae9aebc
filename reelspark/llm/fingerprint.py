"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions alone.

Words are runs of non-space characters of lower-case text; a shingle is ``words`` of them (a text of fewer words has one, of all; without words, none).
A sketch is the ``k`` smallest distinct 64-bit shingle hashes, ascending. The k smallest of two sketches' union are the sketch of both texts' shingles, so parts
merge; the share of those that both sketches hold estimates resemblance; the k-th smallest, how many distinct shingles there are; both
together, containment. A sketch shorter than k is the whole set, and its estimates are exact.

Null text is empty: its sketch is empty and its fingerprint ''. Two empty sketches are alike (1.0), an empty and another one not (0.0). In document order, null ids come
first, ties go by text; repeated rows follow each other. Ids that are texts are ordered as texts. Other columns are ignored. An empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, NumericType

from reelspark.operators.ordered import numbered

WORDS, K, ROWS, MOST_RANGES = 5, 128, 2000, 20_000


def sketch(text: Column, words: int = WORDS, k: int = K) -> Column:
    """array<long> of a text column."""
    hashed = F.transform(F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != ""), lambda w: F.xxhash64(w))
    one = lambda h: F.when(F.size(h) == 0, F.array().cast("array<long>")).otherwise(F.array(F.xxhash64(h)))
    many = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - words), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(words)]))
    runs = lambda h: F.when(F.size(h) < words, one(h)).otherwise(many(h))
    found = F.transform(F.array(hashed), lambda h: F.slice(F.sort_array(F.array_distinct(runs(h))), 1, k))  # bound once: the words are not split again for each shingle
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<long>")).otherwise(F.get(found, F.lit(0)))


def merge(a: Column, b: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    both = merge(a, b, k)
    return F.when(F.size(both) == 0, 1.0).otherwise(F.size(F.array_intersect(F.array_intersect(both, a), b)) / F.size(both)).cast("double")


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    rank = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / F.greatest(rank, F.lit(2.0**-64)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has."""
    j = resemblance(a, b, k)
    shared = j / (1 + j) * (distinct_shingles(a, k) + distinct_shingles(b, k))
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def from_text(fingerprint: Column) -> Column:
    """The sketch that a fingerprint writes."""
    parts = F.filter(F.split(fingerprint, "(?<=\\G.{16})"), lambda x: x != "")
    return F.transform(parts, lambda x: F.conv(x, 16, -10).cast("long"))


def place(doc_id: Column, kind: DataType) -> Column:
    """What ranges of ids are cut by: a text itself; of a number a long of less than 53 bits, which a double holds exactly, that does not descend as ids ascend: the upper bits of a long, of a fraction what is before the point."""
    if isinstance(kind, LongType):
        return F.when(doc_id.between(-(1 << 51), 1 << 51), doc_id).otherwise(F.when(doc_id > 0, F.lit(1 << 51)).otherwise(F.lit(-(1 << 51))) + F.shiftright(doc_id, 12))
    if isinstance(kind, NumericType):
        return F.floor(F.greatest(F.least(doc_id.cast("double"), F.lit(2.0**51)), F.lit(-(2.0**51)))).cast("long")
    return doc_id.cast("string")


def quantiles(some: DataFrame, parts: int, kind: DataType) -> list:
    """parts - 1 places (fewer, if some are equal) that cut those of ``some`` into equal shares; texts are numbered along their order, and only every nth comes to the driver."""
    if isinstance(kind, NumericType):
        return some.agg(F.percentile_approx("place", [i / parts for i in range(1, parts)], 10 * parts).alias("q")).first().q or []
    known = some.where("place is not null").select("place")
    each = max(1, -(-known.count() // parts))
    return [r.place for r in numbered(known, [], ["place"], "nth").where(F.col("nth") % each == 0).select("place").collect()]


def neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = ROWS, what=None) -> DataFrame:
    """doc_id, text, made, next_text, next_made: each document and the next in the order of ids (after the last, the first). ``made``: what(text).

    Ids (numbers or texts) are cut, at quantiles of one in rows / 50 of them, into ranges of about ``rows`` documents, each of which one task sorts; a range's first documents are
    also sent to the range before, so that one shuffle serves all. There are at most MOST_RANGES ranges: the cuts that the plan holds do not grow beyond that, the ranges then do, and sorting spills.
    """
    kind = docs.schema[doc_id].dataType
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("place", place(F.col("doc_id"), kind))
    ids = base.agg(F.count("*").alias("n"), F.count("doc_id").alias("known"), F.min("doc_id").alias("first"), F.min("place").alias("start")).first()
    parts = min(MOST_RANGES, max(1, -(-ids.n // rows)))
    some = base.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, ids.n // (50 * parts)))) == 0)  # as Spark's own ranges are cut: results do not depend on where
    cuts = quantiles(some, parts, kind) if parts > 1 and ids.known else []
    cuts = sorted(set(cuts) - {ids.start}, key=lambda x: x.encode() if isinstance(x, str) else x)
    step = max(1, int(len(cuts) ** 0.5))
    of = "long" if isinstance(kind, NumericType) else "string"
    coarse = F.lit(cuts[::step] or [None]).cast(f"array<{of}>")
    fine = F.lit([cuts[i : i + step] for i in range(0, len(cuts), step)] or [[None]]).cast(f"array<array<{of}>>")
    upto = lambda array: F.size(F.filter(array, lambda c: F.coalesce(c <= F.col("place"), F.lit(False))))
    block = upto(coarse)
    at = F.when(block == 0, 0).otherwise((block - 1) * step + upto(F.get(fine, F.greatest(block, F.lit(1)) - 1)))
    first = F.lit(None if ids.n > ids.known else ids.first).cast(kind)
    begins = (F.col("at") > 0) & F.array_contains(F.get(fine, F.floor((F.col("at") - 1) / step).cast("int")), F.col("place"))
    starts = F.coalesce(F.col("doc_id").eqNullSafe(first) | begins, F.lit(False))
    before = F.when(F.col("doc_id").eqNullSafe(first), F.lit(len(cuts))).otherwise(F.col("at") - 1)
    own = F.struct(F.col("at"), F.lit(True).alias("own"))
    placed = base.withColumn("at", at).withColumn("to", F.explode(F.when(starts, F.array(own, F.struct(before.alias("at"), F.lit(False).alias("own")))).otherwise(F.array(own))))
    sent = placed.select("to.at", "to.own", "doc_id", "text").repartitionById(len(cuts) + 1, "at")
    full = sent.withColumn("made", what(F.col("text"))) if what else sent.withColumn("made", F.lit(None))
    order = Window.partitionBy("at").orderBy(F.col("own").desc(), F.asc_nulls_first("doc_id"), "text")
    return full.withColumns({"next_text": F.lead("text").over(order), "next_made": F.lead("made").over(order)}).where("own").select("doc_id", "text", "made", "next_text", "next_made")


def report(docs: DataFrame, words: int = WORDS, k: int = K, **how) -> DataFrame:
    """Digest of each document and of its edited text: the last quarter of its characters replaced by the next document's first as many."""
    near = neighbours(docs, what=lambda text: sketch(text, words, k), **how)
    size = F.length("text")
    cut = F.floor(size / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), size - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    whole = near.select("doc_id", size.cast("long").alias("n_chars"), "made", "next_made", edited.alias("edited"))
    again = whole.select("doc_id", "n_chars", "made", "next_made", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), F.explode(F.array(sketch(F.col("edited"), words, k))).alias("again"))
    return again.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("made")).alias("fingerprint"), as_text(F.col("again")).alias("edited_fingerprint"), resemblance(F.col("made"), F.col("again"), k).alias("near_edited"), resemblance(F.col("made"), F.col("next_made"), k).alias("near_next"), distinct_shingles(F.col("made"), k).alias("distinct_estimate"))
