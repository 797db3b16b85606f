"""The registered queries: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from prospectra.llm import (
    collocations, conversation_trie, decontaminate, exact_substrings, language, mixing, near_dedup, pii, quality_rules, secret_scan, token_counts, token_planes, warc,
)
from prospectra.llm.common import fields, table
from prospectra.session import new_path


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, and when it first does."""
    return mixing.mix(table(spark, sf_dir, "documents")).drop("positions")


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    return fields(found.select("doc_id", secret_scan.span_digests(F.col("spans")).alias("_s")), ["doc_id"], "_s")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition measures and verdict of every document."""
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those whose crc32 of the id is not 2 modulo 4."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    found = language.identify(table(spark, sf_dir, "documents"), F.coalesce(~held_out, F.lit(False)))
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that lie in repeated strings."""
    return exact_substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near-duplicates of every document."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    path = new_path(spark, "llm-warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    records = warc.read_warc(spark, path, payloads=False).filter("reason IS NULL")
    number = lambda c: F.expr(f"try_cast({c} AS BIGINT)")
    return records.select(warc.id_of(F.col("record_id")).alias("_id"), warc.id_of(F.col("refers_to")).alias("_to"), "*").select(
        number("_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("_to").alias("refers_to")
    )


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("stretches", "items")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.span_digests(pii.find_pii(table(spark, sf_dir, "documents")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collocations of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document written to files of byte planes and read back."""
    path = new_path(spark, "llm-ids")
    token_planes.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_planes.read_ids(spark, path, with_ids=False).withColumnRenamed("key", "doc_id")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shared prefix of the conversations, rebuilt from their trunks."""
    rows = conversation_trie.listed(table(spark, sf_dir, "conversations"))
    return conversation_trie.trie(conversation_trie.branched(rows))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_source_mixing, op3_secret_scans, op4_quality_rules, op5_language_id, op6_suffix_array_dedup,
    op7_minhash_near_dedup, op8_warc, op9_benchmark_decontamination,
    op10_pii, op11_collocations, op12_token_ids, op13_prefix_trie,
)}
ORACLE_SQL = {"op2_source_mixing": mixing.ORACLE_SQL, "op8_warc": warc.ORACLE_SQL}
