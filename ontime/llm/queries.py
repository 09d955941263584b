"""One registered query per operator, over its whole table."""

from __future__ import annotations

import json
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime.llm import (
    alignment, chat, embeddings, licenses, lm, mixing, packing, pieces, quality, sharding, simhash, trie, urls,
)
from ontime.llm.common import table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.table_turns(table(spark, sf_dir, "conversations"), "conv_id")
    # The added conversation comes in another layout, so its record chooses its own mapping.
    said = "</s>[INST] ok [/INST]"
    record = json.dumps({"messages": [{"role": role, "content": said} for role in ("user", "assistant")]})
    added = spark.range(1).select(F.lit(-1).cast("bigint").alias("conv_id"), F.lit(record).alias("record"))
    more = chat.record_turns(added, "conv_id", "record").select("id", F.inline("turns"))
    return chat.chat_digests(chat.format_chats(turns.unionByName(more)))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).select(
        F.col("id").alias("page_id"), "host", "path", "rule", "verdict"
    )


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.piece_digests(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return quality.judged_statistics(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_report(docs)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    return alignment.align(
        table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model")
    ).withColumnRenamed("id", "doc_id")


def op12_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pieces.text_digests(pieces.encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model")))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_QUERIES = (
    op1_chat_format, op2_url_filter, op3_simhash_near_dedup, op4_packing, op5_quality_rules, op6_embedding_near_dedup,
    op7_license_scan, op8_sharding, op9_lm_scoring, op10_source_mix,
    op11_token_alignment, op12_piece_encoding, op13_conversation_trie, pipeline,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_format": chat.SQL, "op10_source_mix": mixing.SQL, "op13_conversation_trie": trie.SQL}
