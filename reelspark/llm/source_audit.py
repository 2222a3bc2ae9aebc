"""How far the sources of each language are from one another and from the language as a whole, by DuckDB aggregation over shards.

Tasks count the terms of their documents (occurrences, and documents that have them) for each language and source, and send one row for each term. Rows are dealt by
a hash of language and term into shards; a task takes whole shards, as many at a time as fit its row bound, and DuckDB merges their counts. A second pass over the kept terms, in the same shards,
adds up in DuckDB what two sources that both have a term add to their divergence, and ranks each source's terms within the shard. Spark merges these sums and rankings.

All arithmetic is exact. With f(p, q) = (p - q)^2 // q and p0 the value of a term that a source lacks, the sum over all kept terms of f(p, q) is V f(p0, q0), plus f(p, q0) - f(p0, q0) for
each term of the first source, plus f(p0, q) - f(p0, q0) for each term of the second, plus the rest for terms that both have. So the work follows the terms that are there, not languages x
terms x pairs of sources; the two middle sums need only how many terms a source has of each count.

Null text, language and source are empty strings. Texts of any length are counted in parts of ``PART_BYTES``. Repeated rows are documents of their own. Other columns are ignored. An empty table gives no row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import duckdb
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelspark.llm.arrow import steps
from reelspark.llm.shared import saved

#: Letters A-Z in lower case, a-z and bytes from 0x80 on as they are; all else parts terms.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SCALE = 1_000_000_000
PART_BYTES, MOST_ENTRIES, SHARD_ROWS = 1 << 22, 300_000, 500_000
SHARDS_A_PARTITION = 4


def terms_in(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists from parts of about PART_BYTES."""
    lowered, at = text.translate(LOWER), 0
    while at < len(lowered):
        end = lowered.find(b" ", at + PART_BYTES)
        end = len(lowered) if end < 0 else end
        yield lowered[at:end].split()
        at = end


def counted(docs: DataFrame) -> DataFrame:
    """lang, source, term (bytes), n (occurrences), docs (documents that have it): counts of one task's documents, several rows for a term where a task has many."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def taken() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, have) in held.items():
                terms = list(n)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(terms), pa.string()), "source": pa.array([source] * len(terms), pa.string()), "term": pa.array(terms, pa.binary()), "n": pa.array(list(n.values()), pa.int64()), "docs": pa.array([have[t] for t in terms], pa.int64())})
            held.clear()

        for batch, raw in steps(batches, "text"):
            for lang, source, x in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), raw, strict=True):
                n, have = held.setdefault((lang, source), (Counter(), Counter()))
                seen: set[bytes] = set()
                for part in terms_in(x):
                    n.update(part)
                    seen.update(part)
                have.update(seen)
            if sum(len(n) for n, _ in held.values()) > MOST_ENTRIES:
                yield from taken()
        yield from taken()

    return docs.mapInArrow(count, "lang string, source string, term binary, n long, docs long")


def by_shards(rows: DataFrame, sql: str, schema: str) -> DataFrame:
    """The result of DuckDB's ``sql`` over whole shards of ``rows`` (all rows of a language and term are in one), SHARD_ROWS or a shard at a time."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shard = F.pmod(F.xxhash64("lang", "term"), F.lit(SHARDS_A_PARTITION * partitions)).cast("int")
    dealt = rows.withColumn("shard", shard).repartition(partitions, "shard").sortWithinPartitions("shard")

    def aggregate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = duckdb.connect(config={"threads": 1})

        def answered(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            con.register("rows", pa.Table.from_batches(held))
            yield from con.sql(sql).to_arrow_table().to_batches(max_chunksize=50_000)
            con.unregister("rows")

        held, size, last = [], 0, None
        for batch in batches:
            if not len(batch):
                continue
            shards = batch.column("shard").to_numpy()
            # Rows of shards that end here; the last shard of a batch may go on in the next one.
            if held and size >= SHARD_ROWS and shards[-1] != last:
                cut = int((shards == last).sum())
                held.append(batch.slice(0, cut))
                yield from answered(held)
                held, size, batch = [], 0, batch.slice(cut)
            held.append(batch)
            size += len(batch)
            last = shards[-1]
        if held:
            yield from answered(held)
        con.close()

    return dealt.mapInArrow(aggregate, schema)


def merge_sql(least_docs: int) -> str:
    return f"""
WITH merged AS (SELECT lang, source, term, sum(n)::BIGINT AS n, sum(docs) AS docs FROM rows GROUP BY ALL)
SELECT lang, source, term, n, row_number() OVER (PARTITION BY lang, term ORDER BY source) = 1 AS once
FROM merged QUALIFY sum(docs) OVER (PARTITION BY lang, term) >= {least_docs}"""


def audit_sql(top: int) -> str:
    return f"""
WITH p AS (
  SELECT lang, source, term, 1 + ({SCALE}::HUGEINT * (n + 1) // own)::BIGINT AS p, 1 + {SCALE} // own AS p0,
    1 + ({SCALE}::HUGEINT * (sum(n) OVER (PARTITION BY lang, term) + 1) // whole)::BIGINT AS q FROM rows),
far AS (SELECT lang, source, term, (p - q) * (p - q) // q AS value FROM p WHERE p > q QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, term) <= {top}),
both_have AS (
  SELECT a.lang, a.source, b.source AS item,
    sum((a.p - b.p) * (a.p - b.p) // b.p - (a.p - b.p0) * (a.p - b.p0) // b.p0 - (a.p0 - b.p) * (a.p0 - b.p) // b.p + (a.p0 - b.p0) * (a.p0 - b.p0) // b.p0)::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL)
SELECT 'term' AS part, lang, source, term AS item, value::BIGINT AS value FROM far
UNION ALL SELECT 'pair', lang, source, encode(item), value FROM both_have"""


def f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def p_of(n: Column, size: Column) -> Column:
    wide = lambda c: c.cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", wide(F.lit(SCALE)) * wide(n + 1), wide(size))


def sources(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, own (N + V of the group), whole (N + V of the language), terms (V) of each group that occurs."""
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("all"), F.count_if("once").alias("terms"))
    every = docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["n", "all", "terms"])
    return every.select("lang", "source", (F.col("n") + F.col("terms")).alias("own"), (F.col("all") + F.col("terms")).alias("whole"), "terms")


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank. Part ``pair``: each other source of the language and the divergence from it. Part ``term``: the ``top`` kept terms that the source has more of than the language."""
    base = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    kept = saved(by_shards(counted(base), merge_sql(least_docs), "lang string, source string, term binary, n long, once boolean"))
    groups = saved(sources(base, kept))
    sized = kept.select("lang", "source", "term", "n").join(groups.select("lang", "source", "own", "whole"), ["lang", "source"])
    found = saved(by_shards(sized, audit_sql(top), "part string, lang string, source string, item binary, value long").withColumn("item", F.col("item").cast("string")))

    p0 = groups.where("terms > 0").withColumn("p0", p_of(F.lit(0), F.col("own")))
    other = p0.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0"))
    constant = p0.join(other, "lang").where("source <> other").select("lang", "source", F.col("other").alias("item"), (F.col("terms") * f(F.col("p0"), F.col("q0"))).alias("value"))
    # For each source, how many terms it has of each count: what these add, as first and as second of a pair.
    counts = kept.groupBy("lang", "source", "n").agg(F.count("*").alias("k")).join(p0.select("lang", "source", "own", "p0"), ["lang", "source"])
    counts = counts.withColumn("p", p_of(F.col("n"), F.col("own"))).join(other, "lang").where("source <> other")
    p, a0, b0, k = (F.col(c) for c in ("p", "p0", "q0", "k"))
    sides = counts.groupBy("lang", "source", "other").agg(F.sum(k * (f(p, b0) - f(a0, b0))).alias("first"), F.sum(k * (f(b0, p) - f(b0, a0))).alias("second"))
    first = sides.select("lang", "source", F.col("other").alias("item"), F.col("first").alias("value"))
    second = sides.select("lang", F.col("other").alias("source"), F.col("source").alias("item"), F.col("second").alias("value"))
    both = found.where("part = 'pair'").select("lang", "source", "item", "value")
    none = groups.where("terms = 0").select("lang", "source")
    none = none.join(none.select("lang", F.col("source").alias("item")), "lang").where("source <> item").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    pairs = constant.unionByName(first).unionByName(second).unionByName(both).unionByName(none).groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))

    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    part = lambda rows, name: rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", ranked.cast("int").alias("rank"))
    return part(pairs, "pair").unionByName(part(found.where("part = 'term'"), "term").where(F.col("rank") <= top))
