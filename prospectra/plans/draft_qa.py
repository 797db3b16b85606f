"""Verdict on drafted mails: ordered failures, limits as parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.functions.text import draft_metrics, joined_failures


def verdicts(
    drafts: DataFrame, business_name: Column | None = None, min_words: int = 25,
    max_words: int = 250, max_subject: int = 90,
) -> DataFrame:
    """Adds every measurement, ``failures`` and ``passed`` to drafts (subject, body)."""
    measured = drafts
    for name, column in draft_metrics(F.col("subject"), F.col("body"), business_name).items():
        measured = measured.withColumn(name, column)
    empty = F.trim(F.regexp_replace(F.coalesce("body", F.lit("")), r"\s+", " ")) == ""
    failures = joined_failures([
        (empty, "empty_body"),
        (~empty & ~F.col("ends_terminated"), "unterminated_body"),
        (~empty & (F.col("body_words") < min_words), "body_too_short"),
        (F.col("body_words") > max_words, "body_too_long"),
        (F.col("subject_chars") > max_subject, "subject_too_long"),
        (F.size("foreign_chars") > 0, "non_latin_script"),
        (F.size("html_entities") > 0, "html_entity"),
        (F.col("has_markdown"), "markdown"),
        (F.col("has_sign_off"), "sign_off"),
    ])
    return measured.withColumn("failures", failures).withColumn("passed", F.size("failures") == 0)
