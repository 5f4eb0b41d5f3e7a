"""The registered queries: each operator over its whole table, with the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabgrid.llm import (
    centroids,
    chat,
    chunk_dedup,
    embed_dedup,
    lexical_search,
    lm_score,
    mixing,
    packing,
    quality,
    simhash,
    suffix_dedup,
    token_counts,
    warc,
)
from cabgrid.llm.common import table
from cabgrid.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.col("sha256").alias("kept_sha256")
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), added_tokens=True)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    page = lambda col: F.element_at(F.split(col, ":"), -2).try_cast("long")
    fields = ["record_id", "record_type", "payload_digest", "payload_bytes", "refers_to"]
    return warc.transactions(warc.read_records(spark, path), fields).select(
        page(F.col("capture_id")).alias("page_id"),
        "response.payload_bytes",
        "response.payload_digest",
        "response.record_type",
        page(F.col("response.refers_to")).alias("refers_to"),
        F.col("request.record_id").alias("request_id"),
        F.col("metadata.record_id").alias("metadata_id"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).drop("text_hash", "host", "common_lines")


def op5_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame(
        [(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    chats = chat.format_chats(turns).withColumn("turns", chat.read_turns(F.col("formatted")))
    loss = chat.read_loss(F.col("formatted"), F.col("loss_spans"))
    each = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(each, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, mixing.cycled_weights(docs, [3, 1, 2]))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and the digest of the text that stays, per document."""
    return chunk_dedup.dedup_chunks(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        "n_chunks",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4).select(
        "doc_id", "fingerprint", "component_id"
    )


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-log-likelihood of every document under the network trained on all of them."""
    return lm_score.lm_scores(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), limit=1024)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"), k=40, rounds=5)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_packing,
        op3_warc,
        op4_quality,
        op5_embed_dedup,
        op6_chat,
        op7_mixing,
        op8_chunk_dedup,
        op9_simhash,
        op10_lm_score,
        op11_lexical_search,
        op12_token_counts,
        op13_centroids,
        pipeline,
    )
}
