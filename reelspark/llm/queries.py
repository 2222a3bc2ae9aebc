"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from reelspark.llm import chat, chosen_path, decontaminate, fingerprint, language, ngram_join, pack, passages, prefix_trie, quality, source_audit, suffix_dedup, toxicity
from reelspark.llm.labelled import held_out, labelled_documents


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~held_out("doc_id", 4, 2)).select("text", "lang"))
    named = language.identify(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return named.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "rejected")


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    rows = labelled_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic", 4, 2, 4 * toxicity.SAMPLE)
    return toxicity.fit(rows)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir), column="score", keep=["doc_id"])
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.find(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labelled = labelled_documents(docs, table(spark, sf_dir, "labels"), "quality", 3, 1, 2 * quality.SAMPLE)
    scored = quality.score(docs, quality.fit(labelled, docs), keep=["doc_id"])
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.report(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.report(table(spark, sf_dir, "documents"))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_toxicity": op2_toxicity,
        "op3_suffix_array_dedup": op3_suffix_array_dedup,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_quality": op5_quality,
        "op6_packing": op6_packing,
        "op7_chat_formatting": op7_chat_formatting,
        "op8_fingerprints": op8_fingerprints,
        "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
        "op10_decontamination": op10_decontamination,
        "op11_minhash_near_dedup": op11_minhash_near_dedup,
        "op12_source_audit": op12_source_audit,
        "op13_prefix_trie": op13_prefix_trie,
        "pipeline": corpus_pipeline.run,
    }


OP10_SQL = r"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + 9], ' ') AS s
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
spots AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM lowered, sizes, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
found AS (SELECT doc_id, i, spots.n, item_id FROM spots JOIN windows USING (n, s)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, i, n FROM found), unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM lowered LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""


OP3_SQL = r"""
WITH bytes AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
starts AS (SELECT r, unnest(range(0, len(x) // 2 - 399)) AS i, unnest(list_transform(range(0, len(x) // 2 - 399), lambda i: hash(substring(x, (2 * i + 1)::BIGINT, 800)))) AS m FROM bytes),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY m) AS c FROM starts) WHERE c > 1),
marked AS (SELECT r, i, CASE WHEN i <= 400 + lag(i) OVER (PARTITION BY r ORDER BY i) THEN 0 ELSE 1 END AS fresh FROM twice),
runs AS (SELECT r, min(i) AS a, max(i) + 400 AS b FROM (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS g FROM marked) GROUP BY r, g),
gaps AS (
  SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS b FROM runs
  UNION ALL
  SELECT r, max(b) AS a, 1000000000 AS b FROM runs GROUP BY r),
kept AS (SELECT r, string_agg(substring(x, (2 * a + 1)::BIGINT, (2 * (b - a))::BIGINT), '' ORDER BY a) AS k FROM gaps JOIN bytes USING (r) GROUP BY r),
gone AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k, x))) AS kept_sha256
FROM bytes LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""

OP9_SQL = r"""
WITH RECURSIVE lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g
  FROM lowered, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (
  SELECT doc_id AS x, doc_id AS y FROM lowered
  UNION
  SELECT r.x, b.y FROM reached r JOIN both_ways b ON b.x = r.y)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, min(r.y)::BIGINT AS component_id
FROM lowered d JOIN reached r ON r.x = d.doc_id LEFT JOIN sizes s USING (doc_id) GROUP BY d.doc_id, s.n
"""


OP7_SQL = r"""
WITH base AS (
  SELECT conv_id, turn, role, replace(coalesce(text, ''), '<|', '< |') AS body,
    row_number() OVER (PARTITION BY conv_id, turn ORDER BY role NULLS FIRST, encode(coalesce(text, ''))) - 1 AS tie FROM conversations),
speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role IS NOT NULL AND role <> 'system'),
seen AS (
  SELECT b.conv_id, s.perspective, b.turn, b.tie, b.role, b.body, b.role IS NOT DISTINCT FROM s.perspective AS own
  FROM base b JOIN speakers s ON b.conv_id IS NOT DISTINCT FROM s.conv_id),
headed AS (
  SELECT *, CASE WHEN own THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>' WHEN role IS NULL THEN '<|user|>'
    ELSE '<|user name=' || replace(role, '<|', '< |') || '|>' END || chr(10) AS head
  FROM seen)
SELECT conv_id, perspective, turn, tie, role, head || body || '<|end|>' || chr(10) AS segment,
  CASE WHEN own THEN length(head) ELSE 0 END::BIGINT AS mask_start, CASE WHEN own THEN length(head) + length(body) + 8 ELSE 0 END::BIGINT AS mask_end
FROM headed
"""


#: The same with three words in a shingle, and which document stays.
OP11_SQL = (
    OP9_SQL.replace("w[i : i + 3]", "w[i : i + 2]")
    .replace("len(w) - 3", "len(w) - 2")
    .replace("min(r.y)::BIGINT AS component_id", "min(r.y)::BIGINT AS component_id, d.doc_id = min(r.y) AS kept")
)


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT d.lang, source, coalesce(v, 0) AS v, coalesce(n, 0) AS whole FROM d LEFT JOIN v USING (lang)),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 1) // (coalesce(n.n, 0) + g.v))::BIGINT AS p,
    1 + (1000000000::HUGEINT * (k.c + 1) // (g.whole + g.v))::BIGINT AS q
  FROM g JOIN kept k USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  UNION ALL SELECT a.lang, a.source, b.source, 0 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source WHERE a.v = 0),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE c > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', item, value::BIGINT, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM terms QUALIFY rank <= 200
"""


OP13_SQL = r"""
WITH own AS (
  SELECT conv_id AS c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS v FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
headed AS (
  SELECT c, v, xor(4294967295, list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda a, b: list_reduce(range(8), lambda s, i: CASE WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END, xor(a, b)), 4294967295)) % 4 AS h FROM own),
made AS (SELECT o.c, list_concat(coalesce(d.v, [])[1 : h], o.v[h + 1 :]) AS v FROM headed o LEFT JOIN own d ON d.c = o.c - o.c % 20),
member AS (SELECT c, d AS depth, v[1 : d] AS p, len(v) = d AS ends FROM made, unnest(range(0, len(v) + 1)) AS t(d)),
node AS (
  SELECT depth, p, min(c) AS conv_id, count(*) AS n_convs, bool_and(ends) AS childless, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ids,
    CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(p[depth]['text'], '[^\x20\x09-\x0D]+')) END AS words
  FROM member GROUP BY depth, p),
below AS (
  SELECT a.conv_id, a.depth, count(*) FILTER (b.depth = a.depth + 1) AS n_children, count(*) FILTER (b.childless) AS n_leaves, sum((b.n_convs - 1) * b.words)::BIGINT AS saved_tokens
  FROM node b, unnest(range(0, b.depth + 1)) AS t(d) JOIN node a ON a.depth = d AND a.p = b.p[1 : d] GROUP BY a.conv_id, a.depth)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, saved_tokens, sha256(n.ids) AS ends_sha256
FROM node n JOIN below USING (conv_id, depth) LEFT JOIN node q ON q.depth = n.depth - 1 AND q.p = n.p[1 : n.depth - 1]
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_suffix_array_dedup": OP3_SQL, "op7_chat_formatting": OP7_SQL, "op9_ngram_jaccard_join": OP9_SQL, "op10_decontamination": OP10_SQL, "op11_minhash_near_dedup": OP11_SQL, "op12_source_audit": OP12_SQL, "op13_prefix_trie": OP13_SQL}
