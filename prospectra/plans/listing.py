"""Directory listings merged into the master: service, match, insert on-profile rows, update the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from prospectra.functions.emails import clamp
from prospectra.functions.identity import name_key, none_if_blank, phone_key
from prospectra.operators.match import waterfall_match
from prospectra.operators.merge import insert_absent
from prospectra.plans.scoring import BASE_SCORE, directory_primary, directory_service, lookup, tier

LISTING_POINTS = 7
LISTING_SOURCE = "yellow_pages"
EVIDENCE = "yellow_pages_paid_listing"


def prepared(listings: DataFrame) -> DataFrame:
    """Collapsed listings with match keys and service line."""
    return listings.withColumn("phone_normalized", phone_key("phone")) \
        .withColumn("name_city_state_key", name_key("name", "city", "state")) \
        .withColumn("service_category", directory_service(F.col("categories")))


def match(listings: DataFrame, businesses: DataFrame, fallback: str = "if_null") -> DataFrame:
    """Listing -> business by phone, by name key only when the phone is NULL; newest business wins."""
    newest = [-F.unix_micros("date_discovered")]
    return waterfall_match(
        listings, businesses, "listing_id", "id", ["phone_normalized", "name_city_state_key"], newest, fallback
    )


def new_businesses(listings: DataFrame, matches: DataFrame, cutoffs=(70, 50, 30)) -> DataFrame:
    """Unmatched listings with a service line, with their starting score."""
    site = none_if_blank(F.col("website"))
    points = lookup(BASE_SCORE, F.col("service_category")) + LISTING_POINTS + F.when(site.isNotNull(), 4).otherwise(-20)
    fresh = listings.join(matches.filter(F.col("matched_id").isNull()).select("listing_id"), "listing_id", "left_semi") \
        .filter(F.col("service_category").isNotNull()) \
        .withColumn("icp_score", clamp(points).cast("int"))
    return fresh.withColumn("icp_tier", tier(F.col("icp_score"), cutoffs)) \
        .withColumn("qc_status", F.when(site.isNull(), "NEEDS_ENRICHMENT").otherwise("VALID")) \
        .withColumn("primary_category", directory_primary(F.col("categories"))) \
        .withColumn("marketing_evidence", F.concat(
            F.lit(f"{EVIDENCE}: "), F.size("categories").cast("string"), F.lit(" categories")))


def updated_businesses(listings: DataFrame, matches: DataFrame, businesses: DataFrame) -> DataFrame:
    """Matched businesses with the listing's categories and evidence merged in.

    The presence of a listing is a column; the +7 is applied from it once,
    so running the merge again changes nothing.
    """
    tags = matches.filter(F.col("matched_id").isNotNull()).join(listings, "listing_id") \
        .select(F.col("matched_id").alias("id"), F.explode_outer("categories").alias("_tag")).distinct() \
        .groupBy("id").agg(F.collect_list("_tag").alias("_tags"))
    old = F.coalesce("categories", F.array().cast("array<string>"))
    evidence = F.col("marketing_evidence")
    listed_before = F.coalesce("directory_listed", F.lit(False))
    joined = businesses.join(tags, "id")
    boosted = F.least(F.lit(100), F.col("icp_score") + F.when(listed_before, 0).otherwise(LISTING_POINTS))
    return joined.withColumn("categories", F.array_sort(F.array_union(old, F.col("_tags")))) \
        .withColumn("marketing_evidence", F.when(evidence.isNull(), EVIDENCE)
                    .when(~F.contains(evidence, F.lit("yellow_pages")), F.concat(evidence, F.lit(f"; {EVIDENCE}")))
                    .otherwise(evidence)) \
        .withColumn("icp_score", boosted).withColumn("icp_tier", tier(F.col("icp_score"), (70, 50, 30))) \
        .withColumn("directory_listed", F.lit(True)).drop("_tags")


def updated_sources(matches: DataFrame, sources: DataFrame) -> DataFrame:
    """The provenance rows (``id, source``) with one entry of the listing per matched business, added once."""
    entries = matches.filter(F.col("matched_id").isNotNull()).select(F.col("matched_id").alias("id"), F.lit(LISTING_SOURCE).alias("source"))
    return insert_absent(sources, entries, ["id", "source"])
