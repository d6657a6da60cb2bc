"""Registered queries of the training-data operators, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tape_audit.llm import attribution, chat, decontamination, language, mixing, packing, quality, sharding, simhash, spelling, token_files, topk, whitening

TOKENIZER = "word_bpe_49k.json"  # of the public tokenizers installed beside the library
BYTE_TOKENIZER = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the labelled ones outside the held-out fold."""
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formatted conversations, read back; conversation -1 says control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(chat.PROBE).alias("text"))
    both = turns.unionByName(probe).withColumn("parts", chat.text_part(F.col("text")))
    return chat.digests(chat.format_chats(both))


ORACLES["op4_chat_formatting"] = chat.DIGESTS_SQL


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files of all documents, read back document by document."""
    return token_files.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), by_word=True)


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on a bounded-load ring of 24 shards."""
    return sharding.shard(table(spark, sf_dir, "documents"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.taken(table(spark, sf_dir, "documents"))


ORACLES["op8_mixing"] = mixing.TAKEN_SQL


@query
def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products for every fiftieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"))


ORACLES["op10_top_k"] = topk.TOP_SQL


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and of each of its lines."""
    return attribution.section_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER))


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from labels outside the held-out fold."""
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), by_word=True).drop("ids")


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the four largest whitened components of the distinct vectors."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their more frequent near words."""
    return spelling.variants(table(spark, sf_dir, "documents"))
