"""Several rows of one thing made into one: provenance, natural keys, unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.operators.merge import first_per_key
from prospectra.operators.skew import pack_rows


def identity_key(*keys: Column) -> Column:
    """First usable identity of a row; rows with none cannot be merged safely."""
    return F.coalesce(*keys)


def provenance(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Distinct provenance entries, one row each: the long form the master table stores."""
    return df.select(key, *fields).distinct()


def provenance_arrays(df: DataFrame, key: str, fields: list[str], max_items: int = 10_000) -> DataFrame:
    """Provenance as sorted arrays of structs, chunked for very large keys."""
    return pack_rows(provenance(df, key, fields), [key], fields, fields, "sources", max_items)


def representatives(df: DataFrame, key: str, by: str, tie: str) -> DataFrame:
    """The row of each key with the largest ``by``, NULLs last, smallest ``tie`` on equality."""
    return first_per_key(df, [key], [F.col(by).desc_nulls_last(), F.col(tie).asc()])


def collapse_listings(
    raw: DataFrame, natural_key: list[str], row_id: str, first_of: list[str], category: str
) -> DataFrame:
    """One row per natural key: first non-blank values, sorted categories, row count, lowest id.

    Categories are made distinct per key before they are gathered, so the array
    is as large as the category vocabulary, never as large as the group.
    """
    blank_safe = raw.select(
        *[F.coalesce(F.col(k), F.lit("")).alias(k) for k in natural_key], row_id, *first_of, category
    )
    per_category = blank_safe.groupBy(*natural_key, category).agg(
        F.count(F.lit(1)).alias("_n"), F.min(row_id).alias("_id"),
        *[
            F.min(F.when(F.col(c) != "", F.struct(F.col(row_id).alias("id"), F.col(c).alias("v")))).alias(c)
            for c in first_of
        ],
    )
    return per_category.groupBy(*natural_key).agg(
        *[F.coalesce(F.min(c)["v"], F.lit("")).alias(c) for c in first_of],
        F.array_sort(F.collect_list(F.when(F.col(category) != "", F.col(category)))).alias("categories"),
        F.sum("_n").alias("source_row_count"),
        F.min("_id").alias("min_source_id"),
    )


def backfill_log(sources: DataFrame, log: DataFrame, row_id: str, seen_at: str) -> DataFrame:
    """Search-log rows rebuilt from provenance: first sighting and distinct holders per search."""
    complete = F.col("query").isNotNull() & F.col("geo_target").isNotNull() & F.col("service_category").isNotNull()
    rebuilt = (
        sources.filter(complete)
        .groupBy("query", "geo_target", "service_category", "phase", row_id)
        .agg(F.min(seen_at).alias("_seen"))
        .groupBy("query", "geo_target", "service_category", "phase")
        .agg(F.min("_seen").alias("searched_at"), F.count(F.lit(1)).alias("results_discovered"))
    )
    return rebuilt.join(log, ["query", "geo_target", "service_category"], "left_anti")


__all__ = [
    "identity_key", "provenance", "provenance_arrays", "representatives",
    "collapse_listings", "backfill_log",
]
