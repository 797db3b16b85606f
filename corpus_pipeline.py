"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from prospectra.llm import decontaminate, mixing, near_dedup, secret_scan
from prospectra.llm import quality_rules as rules
from prospectra.llm.common import cut, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    verdict = docs.select(F.struct(*docs.columns).alias("_row"), rules.quality(F.col("text")).alias("_q"))
    return verdict.filter("_q.kept").select("_row.*")


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_dedup.deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; ``n_chars`` follows a changed text."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), secret_scan.without_secrets(F.col("text")).alias("_text"))
    n_chars = F.when(F.col("_text").isNotNull(), F.length("_text").cast("long")).otherwise(F.col("_row.n_chars"))
    changed = {"text": F.coalesce("_text", "_row.text"), "n_chars": n_chars}
    return rows.select(*[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document, and the training position of every copy."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("source_mixing", source_mixing),
]
#: SQL can't express the sketches and the repetition measures; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
