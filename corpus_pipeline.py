"""A corpus pipeline: quality rules, near-duplicates, repeated passages, source mix, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor
kept; all but the last return the columns of ``documents``. Between stages the
rows are written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabgrid.llm import chunk_dedup, mixing, packing, quality, simhash
from cabgrid.llm.common import table, text_hash
from cabgrid.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = "byte_bpe_50k.json"


def _keyed(df: DataFrame, hashed) -> DataFrame:
    """With the key of a document: its id (the smallest long if null) and the hash of its text."""
    return df.withColumns({"key_id": F.coalesce("doc_id", F.lit(-(1 << 63))), "key_hash": hashed})


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose document is in ``kept``."""
    named = _keyed(kept, F.col("text_hash")).select("key_id", "key_hash")
    return _keyed(docs.select(COLUMNS), text_hash()).join(named, ["key_id", "key_hash"], "left_semi")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines that are common on their host."""
    left = quality.without_common_lines(docs.select(COLUMNS), quality.quality(docs).where("kept"))
    return left.withColumns(
        {"n_chars": F.coalesce(F.length("cut").cast("long"), F.col("n_chars")), "text": F.coalesce("cut", "text")}
    ).select(COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; of rows that repeat it, one."""
    groups = simhash.near_duplicates(docs, shingle=4, max_bits=4)
    return _only(docs, groups.where("kept")).dropDuplicates(["key_id", "key_hash"]).select(COLUMNS)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the chunks that earlier ones have; documents that lose all their words go."""
    cut = chunk_dedup.dedup_chunks(docs).where("n_removed > 0")
    cut = _keyed(cut, F.col("text_hash")).select("key_id", "key_hash", "kept").dropDuplicates(["key_id", "key_hash"])
    joined = _keyed(docs.select(COLUMNS), text_hash()).join(cut, ["key_id", "key_hash"], "left")
    text = F.coalesce("kept", "text")
    return (
        joined.where(F.col("kept").isNull() | (mixing.words_of("kept") > 0))
        .withColumn("n_chars", F.when(F.col("kept").isNull(), F.col("n_chars")).otherwise(F.length(text).cast("long")))
        .withColumn("text", text)
        .select(COLUMNS)
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.repeated(docs, mixing.mix(docs, mixing.cycled_weights(docs, [3, 1, 2]))).select(COLUMNS)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), added_tokens=True).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("quality rules", keep_quality),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("substring dedup", cut_repeated_passages),
    ("mixing sources", mix_sources),
    ("packing", pack_tokens),
]

#: SQL has no XXH64, gear hash or tokenizer. Whole rows of the quality stage are tested against a plain version; the others less.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i + 1 == len(STAGES):
            return out
        path = scratch_path(spark, f"stage{i}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
