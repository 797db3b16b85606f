"""One ingest batch: collapse, match against the master, merge or insert, log."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.functions.identity import none_if_blank, stable_uuid
from prospectra.operators.collapse import identity_key, provenance, representatives
from prospectra.operators.match import waterfall_match
from prospectra.operators.merge import first_per_key, merge_upsert
from prospectra.sources.buckets import BucketTable, Manifest

MATCH_KEYS = ["place_id", "domain", "phone_normalized", "name_city_state_key"]
SOURCE_FIELDS = ["query", "geo_target", "service_category", "phase"]
ALWAYS_FRESH = ("icp_score", "icp_tier", "qc_status")
ID_NAMESPACE = "6f1d2a34-8f3b-5c77-9a54-1b7f6f0f2c11"


@dataclass
class Batch:
    """Results of a batch, as DataFrames."""

    businesses: DataFrame
    provenance: DataFrame
    log: DataFrame
    matched: DataFrame
    source: DataFrame


POLICIES = {c: "overwrite" for c in ALWAYS_FRESH} | {"service_category": "keep_old"}


def keyed(staging: DataFrame) -> DataFrame:
    """Staging rows that have an identity, with their collapse key and a total order."""
    key = identity_key(*[F.col(k) for k in MATCH_KEYS])
    usable = staging.withColumn("dedup_key", key).filter(F.col("dedup_key").isNotNull())
    return usable.withColumn("row_hash", F.xxhash64(*staging.columns))


def run_batch(
    staging: DataFrame, businesses: DataFrame, now: Column,
    cut: Callable[[DataFrame, str], DataFrame] | None = None, hot_keys: int = 64, tie: str = "row_hash",
) -> Batch:
    """Merges one staged batch into the master table.

    Each batch is its own DataFrame; nothing is shared with batches running at
    the same time. ``cut`` may write an intermediate table and read it back,
    which pays off because the match feeds four outputs. Of equally reviewed rows
    of one business the smallest in ``tie`` speaks.
    """
    cut = cut or (lambda df, _: df)
    rows = cut(keyed(staging), "keyed")
    chosen = representatives(rows, "dedup_key", "review_count", tie)
    prefer = [F.coalesce(-F.col("review_count"), F.lit(1))]
    hits = waterfall_match(chosen, businesses, "dedup_key", "id", MATCH_KEYS, prefer, hot_keys=hot_keys)
    matched = cut(chosen.join(hits, "dedup_key"), "matched").withColumn(
        "target_id", F.coalesce("matched_id", stable_uuid(ID_NAMESPACE, F.col("dedup_key")))
    )
    # Two collapse keys may hit one business: the better-reviewed row speaks for it.
    fresh = first_per_key(matched, ["target_id"], [F.col("review_count").desc_nulls_last(), F.col("dedup_key")])
    fields = [c for c in businesses.columns if c in staging.columns]
    source = fresh.select(F.col("target_id").alias("id"), *[
        (none_if_blank(F.col(c)) if c in ("description", "price_range", "status") else F.col(c)).alias(c)
        for c in fields
    ])
    merged = merged_master(businesses, source, now)
    entries = provenance(rows, "dedup_key", SOURCE_FIELDS)
    held = entries.join(matched.select("dedup_key", "target_id"), "dedup_key").select(
        F.col("target_id").alias("id"), *SOURCE_FIELDS, now.alias("discovered_at")
    )
    return Batch(merged, held, batch_log(rows, entries, matched, now), matched, source)


def merged_master(businesses: DataFrame, source: DataFrame, now: Column) -> DataFrame:
    """Master rows after a batch's source rows, one per business, came in."""
    return merge_upsert(businesses, source, ["id"], POLICIES, "coalesce_new", touched="date_updated", now=now) \
        .withColumn("date_discovered", F.coalesce("date_discovered", now))


def store(table: BucketTable, batch: Batch, now: Column) -> Manifest:
    """The batch merged into a master kept in buckets: those it touches are read and rewritten where they lie."""
    count = table.manifest().count
    rows = batch.source.repartition(count, "id")
    return table.change(batch.source.select("id"), lambda old: merged_master(old, rows, now).select(*old.columns))


def batch_log(rows: DataFrame, entries: DataFrame, matched: DataFrame, now: Column) -> DataFrame:
    """One log row per search of the batch: raw results, new, duplicate, qualified, rejected."""
    on = ["query", "geo_target", "service_category"]
    raw = rows.groupBy(*on).agg(F.max("phase").alias("phase"), F.count(F.lit(1)).alias("results_discovered"))
    verdicts = entries.select(*on, "dedup_key").distinct().join(
        matched.select("dedup_key", F.col("matched_id").isNull().alias("_new"),
                       (F.col("qc_status") == "REJECTED").alias("_rejected")), "dedup_key"
    ).groupBy(*[F.col(c).alias(f"_{c}") for c in on]).agg(
        F.count_if("_new").alias("new_businesses"), F.count_if(~F.col("_new")).alias("duplicates"),
        F.count_if(~F.col("_rejected")).alias("qualified"), F.count_if("_rejected").alias("rejected"),
    )
    same = raw["query"].eqNullSafe(verdicts["_query"]) & (raw["geo_target"] == verdicts["_geo_target"]) \
        & (raw["service_category"] == verdicts["_service_category"])
    counts = ["new_businesses", "duplicates", "qualified", "rejected"]
    return raw.join(verdicts, same, "left").select(
        *on, "phase", now.alias("searched_at"), "results_discovered",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
    )
