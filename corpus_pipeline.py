"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept, written as Parquet and read again. ``run`` keeps the tables in the folder that ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.folders import fresh_folder
from reelspark.llm import decontaminate, ngram_join, pack, suffix_dedup, toxicity
from reelspark.llm.labelled import labelled_documents


#: A passage of over 50 words that repeats is to go: 51 words take 200 bytes or more where a word and its blank take 4, which is less than in the languages at hand.
REPEAT_BYTES = 200


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go. The model learns from labelled documents that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(labelled_documents(docs, labels, "toxic", 4, 2, 4 * toxicity.SAMPLE))
    return toxicity.drop_toxic(docs, model)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share four fifths of their five-word runs, directly or by way of others, the one with the smallest id stays."""
    return ngram_join.deduplicate(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of REPEAT_BYTES that occur twice go from every text; n_chars follows."""
    return suffix_dedup.clean(docs, length=REPEAT_BYTES).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which ten consecutive words of a benchmark item occur go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens and their places in sequences of 2048."""
    import public_tokenizers

    return pack.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", without_near_copies),
    ("suffix_array_dedup", without_repeats),
    ("benchmark_decontamination", without_benchmark),
    ("packing", packed),
]

#: Compression distances, suffix sorting and tokenization are not SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
