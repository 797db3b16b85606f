"""Patterns of a key searched in the rows of that key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from prospectra.functions.patterns import found_patterns, pattern_hits
from prospectra.operators.skew import salted_join

#: Patterns in one automaton; a key with more has several, and its rows meet each of them.
SET_SIZE = 10_000


def pattern_sets(patterns: DataFrame, keys: list[str], pattern: str, limit: int = SET_SIZE) -> DataFrame:
    """``keys, _patterns``: the distinct patterns of a key in sets of about ``limit``, dealt by hash."""
    own = patterns.filter(F.coalesce(F.col(pattern), F.lit("")) != "").select(*keys, F.col(pattern).alias("_p")).distinct()
    sizes = own.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(limit)).alias("_sets"))
    number = F.pmod(F.xxhash64("_p"), F.col("_sets"))
    return own.join(sizes, keys).groupBy(*keys, number.alias("_set")).agg(F.sort_array(F.collect_list("_p")).alias("_patterns")).drop("_set")


def _told(rows: DataFrame, patterns: DataFrame, keys: list[str], pattern: str, limit: int) -> DataFrame:
    sets = pattern_sets(patterns, keys, pattern, limit)
    return salted_join(rows, sets, keys, "inner")


def patterns_in(rows: DataFrame, patterns: DataFrame, keys: list[str], text: str, pattern: str, limit: int = SET_SIZE) -> DataFrame:
    """``rows`` with each pattern of their key that stands in their text, one row per pattern.

    Every text is read once per set. Keys with a large share of the rows are spread; rows and
    patterns without a key meet nothing.
    """
    told = _told(rows, patterns, keys, pattern, limit).withColumn("_found", found_patterns(F.col(text), F.col("_patterns")))
    return told.drop("_patterns").withColumn(pattern, F.explode("_found")).drop("_found")


def places_in(rows: DataFrame, patterns: DataFrame, keys: list[str], text: str, pattern: str, limit: int = SET_SIZE) -> DataFrame:
    """``rows`` with every place of every pattern: ``start`` in characters from 0, ``whole`` if no word goes on at either end."""
    told = _told(rows, patterns, keys, pattern, limit).withColumn("_hits", pattern_hits(F.col(text), F.col("_patterns")))
    hits = told.select(*rows.columns, "_patterns", F.explode("_hits").alias("_h"))
    return hits.select(*rows.columns, F.get("_patterns", F.col("_h.k")).alias(pattern), F.col("_h.start").alias("start"), (~F.col("_h.left") & ~F.col("_h.right")).alias("whole"))
