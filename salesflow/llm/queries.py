"""One registered query per operator, over the whole of its table.

The queries are thin: each calls its operator with production parameters and
derives the columns that its contract names.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm import (bpe, collocations, embed_dedup, exact_dedup, language_id, line_dedup, packing, quality,
                           sharding, simhash, token_counts, url_filter, whitening)
from salesflow.llm._shared import crc_mod, documents, shared_table
from salesflow.session import unique_table

SHARDS = 24
#: Below this probability a document is rejected.
QUALITY = quality.THRESHOLD


def vocabulary() -> str:
    """Place of the byte-level vocabulary: ``LLM_VOCABULARY``, else the
    installed public one."""
    given = os.environ.get("LLM_VOCABULARY")
    if given:
        return given
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), vocabulary())


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.document_digests(documents(spark, sf_dir), vocabulary())


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.embedding_groups(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    rows = documents(spark, sf_dir).select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    rows = sharding.assign_shards(rows, "doc_id", [1.0] * SHARDS)
    rows = sharding.assign_shards(rows, "doc_id", [1.0] * (SHARDS + 1), "grown_shard")
    return sharding.with_slots(shared_table(rows, "shards"), "shard", ["doc_id", "text_crc32", "size"])


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index that already knows half of the texts (those of an even CRC-32 of
    their digest, with all their rows) takes all documents: the answer is that
    second load's, met by known and by new digests."""
    docs = documents(spark, sf_dir)
    index = exact_dedup.DigestIndex(spark, unique_table("text_digests"))
    index.load(docs.where(F.crc32(exact_dedup.digest(F.col("text"))) % 2 == 0))
    out = index.load(docs)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP6_SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)"""


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, ("doc_id", "text", "lang")).withColumn(
        "held_out", crc_mod(F.col("doc_id"), 4) == 2)
    model = language_id.fit(docs.where("not held_out"))
    return (language_id.predict_languages(docs.select("doc_id", "text", "held_out"), model)
            .select("doc_id", "held_out", "lang_pred", "score", "phrase_bits"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("n_lines", F.size(F.split("text", "\n", -1)))
    return line_dedup.drop_recurring_lines(docs, short_docs=line_dedup.MIN_DOCS).select(
        "doc_id", "n_lines", F.size("dropped_lines").alias("n_dropped"), "dropped_lines", "text")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(crc_mod(F.col("doc_id"), 5) != 0)
    model = quality.fit(docs, labels)
    return (quality.score_documents(docs, model, threshold=QUALITY)
            .select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(documents(spark, sf_dir))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.component_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    # null where the exact sum passes 64 bits
    return out.withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir, ("text", "lang")))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), vocabulary())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_bpe, op3_embedding_dedup, op4_sharding, op5_url_filter,
                            op6_exact_dedup, op7_language_id, op8_line_dedup, op9_quality, op10_simhash,
                            op11_whitening, op12_collocations, op13_token_counts)}
ORACLE: dict[str, str] = {"op5_url_filter": url_filter.oracle(), "op6_exact_dedup": OP6_SQL,
                          "op12_collocations": collocations.oracle()}
