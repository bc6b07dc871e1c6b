"""Registered queries of the operators: ``opN_<name>`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.llm import (alignment, byte_bpe, conversation_repair, embedding_dedup, language_id, mixing, packing, phrases, secrets,
                          sharding, simhash, substring_dedup, token_counts)
from beaconry.llm.common import documents, small_batches

ORACLES: dict[str, str] = {}


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, folder),
                                     public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.remove_repeated(documents(spark, folder), length=35)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op2_substring_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
     p AS (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d),
     k AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS k FROM p),
     again AS (SELECT r, i FROM k QUALIFY count(*) OVER (PARTITION BY k) > 1),
     gone AS (SELECT r, list(DISTINCT j) AS js
              FROM (SELECT r, unnest(range(i, i + 35)) AS j FROM again) GROUP BY r),
     kept AS (SELECT doc_id, w, coalesce(js, []) AS js FROM d LEFT JOIN gone USING (r))
SELECT doc_id, len(w)::BIGINT AS n_words, len(js)::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(js, i)), ' ')) AS kept_sha256
FROM kept
"""


def op3_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{folder}/embeddings.parquet"))


ORACLES["op3_embedding_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
     links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
               WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
     reach AS (SELECT vec_id AS x, vec_id AS y FROM v
               UNION SELECT reach.x, links.b FROM reach JOIN links ON reach.y = links.a),
     root AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
     n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM root LEFT JOIN n USING (vec_id)
"""


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    got = language_id.learn_and_identify(docs, language_id.fold_of("doc_id") != 2)
    return got.select(F.col("id").alias("doc_id"), (language_id.fold_of("id") == 2).alias("held_out"),
                      "lang_pred", "score", "cost", "accepted")


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    placed, pieces = mixing.mix(documents(spark, folder))
    return mixing.taken(placed, pieces).select("doc_id", "size", "source_size", "target", "taken")


def op6_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.fingerprints(documents(spark, folder))


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_records(documents(spark, folder), shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    found = secrets.scan(docs, secrets.train(docs))

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", s["kinds"], s["starts"].cast("string"), s["ends"].cast("string"))))

    def number(kind):
        return F.size(F.filter("kinds", lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    spans = F.arrays_zip("kinds", "starts", "ends")
    base = F.filter(spans, lambda s: s["kinds"] != "learned")
    return found.select("doc_id", number("assign"), number("access"), number("hex"),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"))


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = byte_bpe.encode(documents(spark, folder), ranks, pattern)
    decimal = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    hashed = coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(decimal, 256).alias("ids_sha256"), "ids")
    return (byte_bpe.decode(hashed, ranks, pattern)
            .select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.simhash_groups(documents(spark, folder), words=4, distance=4)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id")


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_corpus(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"),
                                  public_tokenizers.path("piece_bpe_32k.model"))


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2,
                        with_ids=False)


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    damaged = conversation_repair.damage(spark.read.parquet(f"{folder}/conversations.parquet"))
    return conversation_repair.repair(damaged)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_language_id": op4_language_id,
    "op5_mixing": op5_mixing,
    "op6_phrases": op6_phrases,
    "op7_sharding": op7_sharding,
    "op8_secrets": op8_secrets,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_simhash": op10_simhash,
    "op11_alignment": op11_alignment,
    "op12_packing": op12_packing,
    "op13_conversation_repair": op13_conversation_repair,
}
