"""Registered queries of this package: ``name -> fn(spark, sf_dir)``.

Each applies one operator with production parameters to its whole table and
derives the digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from entryflow.llm import (ann, bpe, conversations, divergence, katz, mixing, ngram_join, packing, quality,
                           secret_scan, sharding, substring_dedup, url_filter)
from entryflow.llm.common import table

#: File name of the public vocabulary that the token queries use.
VOCABULARY = "word_bpe_49k.json"
#: Id after the last id of every packed document, and tokens of a sequence.
END_ID, SEQUENCE_TOKENS = 2, 4096
#: Bytes of text that packing cuts at a time in its own query, which has its workers to itself.
PACKING_SLICE = 4_000_000

SHARDS = 40

#: Shingles and similarity of the join's query (the operator's own are 5 words and 80 %).
JOIN_WORDS, JOIN_PERCENT = 4, 85

URL_RULES = [
    url_filter.parse_rule("block", "net/"),
    url_filter.parse_rule("allow", "example.net/en/"),
    url_filter.parse_rule("block", "example.com/de/"),
    url_filter.parse_rule("allow", "org/fr/"),
]


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.drop("row", "drop_lines").withColumnRenamed("id", "doc_id")


def op2_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ann.nearest(table(spark, sf_dir, "embeddings"), lambda i: F.pmod(i, F.lit(20)) == 0)
    return found.withColumnRenamed("id", "vec_id")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    return found.drop("row", "redact").withColumnRenamed("id", "doc_id")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_digests(docs, vocabulary_path()).withColumnRenamed("id", "doc_id")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_components(table(spark, sf_dir, "documents"), k=JOIN_WORDS,
                                       percent=JOIN_PERCENT)
    return found.drop("row").withColumnRenamed("id", "doc_id")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``; the method deals single rows, so equal texts need not meet."""
    placed = sharding.shard(table(spark, sf_dir, "documents"), SHARDS)
    text = F.coalesce("row.text", F.lit(""))
    return placed.select("row.doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                         F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.withColumnRenamed("id", "page_id")


def op8_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = packing.token_pieces(docs, vocabulary_path(), END_ID, SEQUENCE_TOKENS, slice_bytes=PACKING_SLICE)
    return packing.pack(pieces, SEQUENCE_TOKENS)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.repeated_regions(table(spark, sf_dir, "documents"))
    return found.drop("cuts").withColumnRenamed("id", "doc_id")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.drop("copies").withColumnRenamed("id", "doc_id")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(table(spark, sf_dir, "conversations"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_adaptive_scan": op2_adaptive_scan,
    "op3_secret_scan": op3_secret_scan,
    "op4_bpe": op4_bpe,
    "op5_ngram_join": op5_ngram_join,
    "op6_sharding": op6_sharding,
    "op7_url_filter": op7_url_filter,
    "op8_katz": op8_katz,
    "op9_packing": op9_packing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_mixing": op11_mixing,
    "op12_conversations": op12_conversations,
    "op13_divergence": op13_divergence,
}
