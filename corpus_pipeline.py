"""The training-data pipeline: stages over the documents table, each one operator.

A stage gets the documents that its predecessor kept and returns documents with the
same columns; the last one returns their tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.llm import byte_bpe, language_id, mixing, secrets, simhash
from beaconry.llm.common import small_batches
from beaconry.session import scratch_path

#: No SQL: trained models, hashed fingerprints, random draws and tokenizers.
ORACLE_SQL = None


def bounded(stage):
    """The stage with small Arrow batches: memory beside the heap stays the same for long texts."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the language models reject; models learn from the labelled ones."""
    return language_id.learn_and_accept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: five-word shingles, similarity 0.8 or more."""
    return simhash.keep_one(docs, words=5, distance=12, least=0.8)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark; no document goes."""
    clean = secrets.redacted(docs, secrets.train(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source's words up to its target; a document appears up to twice."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = byte_bpe.encode(docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256)),
                            ranks, pattern, keep=("doc_id", "lang", "source", "text_sha256"))
    whole = coded.withColumns({"n_tokens": F.size("ids").cast("long"), "token_ids": F.col("ids")})
    return (byte_bpe.decode(whole, ranks, pattern)
            .withColumn("round_trip", F.sha2("decoded", 256) == F.col("text_sha256")).drop("decoded"))


STAGES = [
    ("language_id", bounded(language)),
    ("simhash_near_dedup", bounded(near_duplicates)),
    ("secret_scan", bounded(secret_scan)),
    ("mixing", bounded(mix_sources)),
    ("byte_bpe", bounded(tokens)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each is written and read again, so that a
    lost executor or a later stage never repeats an earlier one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        path = scratch_path(spark, name)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
