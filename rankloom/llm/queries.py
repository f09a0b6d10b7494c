"""The registered queries of the text operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm import chat, oracle
from rankloom.llm.common import stored, table
from rankloom.llm.log_templates import without_templates
from rankloom.llm.mixing import mix, word_count
from rankloom.llm.near_dup import Settings, near_duplicates
from rankloom.llm.pieces import digests
from rankloom.llm.png import features, store
from rankloom.llm.ppm import scores
from rankloom.llm.quality import quality
from rankloom.llm.token_counts import token_counts
from rankloom.llm.warc import read_archives, resolved, roles, write_archives

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sizes = stored(docs.select("doc_id", "source", F.xxhash64("text").alias("text"), word_count(F.col("text")).alias("_size")), "mix-sizes")
    return mix(sizes, size=F.col("_size")).select("doc_id", "size", "source_size", "target", "taken")


def op3_byte_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_budgeted_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "\\### Assistant: </turn> ok"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.digests(chat.formatted(turns))


def op5_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("byte_bpe_50k.tiktoken")).drop("text")


def op6_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(roles(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    return resolved(read_archives(manifest)).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), settings=Settings(words=3, percent=85))


def op8_log_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = without_templates(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)
    return docs.select("doc_id", "n_lines", "n_dropped", F.length("text").alias("kept_chars"), F.sha2("text", 256).alias("text_sha256"))


def op9_png_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return features(store(docs).drop("text")).withColumn("feature", F.lower(F.hex("cosine_hash"))).drop("cosine_hash")


def op10_sentencepiece_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return oracle.SQL
