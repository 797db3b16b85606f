"""Addresses from stored pages: extract, reject, classify, score, merge per business, roll up."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from prospectra.functions import emails as E
from prospectra.operators.match import fan_out
from prospectra.operators.merge import merge_upsert
from prospectra.operators.stage import staged
from prospectra.operators.topk import budget


def sightings(pages: DataFrame, junk_domains: tuple[str, ...] = E.INFRASTRUCTURE_DOMAINS) -> DataFrame:
    """One row per accepted address on a page, classified and scored.

    Needs business_id, page_seq, url, page_kind, website, text; ``signal_emails``
    (addresses lifted from the markup) is optional and held to the same standard.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    if "signal_emails" in pages.columns:
        text = F.concat_ws(" ", F.array_join(F.coalesce("signal_emails", F.array().cast("array<string>")), " "), text)
    found = pages.select(
        "business_id", "page_seq", "url", "page_kind", "website",
        F.explode(E.addresses_in(text)).alias("email"),
    ).filter(E.reject_reason("email", junk_domains).isNull())
    found = staged(found, E.address_classes("email", "website"))
    return found.withColumn("confidence", E.address_confidence(
        F.col("is_role"), F.col("is_free_mail"), F.col("matches_site_domain"), F.col("page_kind")
    ))


def per_business(seen: DataFrame) -> DataFrame:
    """One row per (business, address): best confidence, its first page, number of sightings."""
    best_page = F.struct(-F.col("confidence"), F.col("page_seq"), F.col("url"))
    flags = ["local_part", "domain", "is_role", "is_free_mail"]
    return seen.groupBy("business_id", "email").agg(
        *[F.first(c).alias(c) for c in flags],
        F.max("matches_site_domain").alias("matches_site_domain"),
        F.max("confidence").alias("confidence"),
        F.min_by(F.struct(F.col("url").alias("source_url"), "page_kind"), best_page).alias("_p"),
        F.count(F.lit(1)).alias("page_count"),
    ).select("business_id", "email", *flags, "matches_site_domain", "confidence",
             "_p.source_url", "_p.page_kind", "page_count")


def best_address(addresses: DataFrame) -> DataFrame:
    """Best address per business: confidence, then sightings, then the address itself."""
    order = F.struct(-F.col("confidence"), -F.col("page_count"), F.col("email"))
    return addresses.groupBy("business_id").agg(
        F.min_by(F.struct("email", "is_role"), order).alias("_b"),
        F.count(F.lit(1)).alias("contact_email_count"),
    ).select("business_id", F.col("_b.email").alias("contact_email"), "contact_email_count",
             F.col("_b.is_role").alias("contact_email_is_role"))


def reject_counts(pages: DataFrame, junk_domains: tuple[str, ...] = E.INFRASTRUCTURE_DOMAINS) -> DataFrame:
    """How many address-like tokens each rule dropped."""
    tokens = pages.select(F.explode(E.loose_addresses_in(F.coalesce("text", F.lit("")))).alias("email"))
    reason = E.reject_reason("email", junk_domains).alias("reason")
    return tokens.select(reason).filter(F.col("reason").isNotNull()).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n")
    )


def class_counts(addresses: DataFrame) -> DataFrame:
    """Personal, role, own-domain and free-mail addresses in one row."""
    return addresses.agg(
        F.count(F.lit(1)).alias("addresses"), F.count_if(~F.col("is_role")).alias("personal"),
        F.count_if("is_role").alias("role"), F.count_if("matches_site_domain").alias("own_domain"),
        F.count_if("is_free_mail").alias("free_mail"),
    )


def store(stored: DataFrame, addresses: DataFrame, now) -> DataFrame:
    """Stored addresses after this run: same key updated in place, its channel left as it was."""
    fresh = addresses.drop("page_count").withColumn("source", F.lit("crawl")).withColumn("extracted_at", now)
    return merge_upsert(stored, fresh, ["business_id", "email"], {"source": "keep_old"})


def select_for_check(
    addresses: DataFrame, verdicts: DataFrame, emails: DataFrame | None = None,
    business_ids: DataFrame | None = None, unverified_limit: int | None = None,
) -> DataFrame:
    """Addresses to check, by exactly one of: listed addresses, listed businesses, top unverified."""
    if sum(x is not None for x in (emails, business_ids, unverified_limit)) != 1:
        raise ValueError("pass exactly one of emails, business_ids or unverified_limit")
    if emails is not None:
        wanted = emails.select(F.lower(F.trim("email")).alias("_e")).distinct()
        return addresses.join(wanted, F.lower(F.col("email")) == F.col("_e"), "left_semi")
    if business_ids is not None:
        return addresses.join(business_ids, "business_id", "left_semi")
    unchecked = addresses.join(verdicts, "business_email_id", "left_anti")
    return budget(unchecked, [
        F.col("confidence").desc_nulls_last(), F.col("extracted_at").asc(), F.col("business_email_id").asc()
    ], unverified_limit)


def match_results(rows: DataFrame, results: DataFrame) -> DataFrame:
    """Check results for every row holding the address; an address without an answer gives nothing."""
    answers = results.select(
        F.lower(F.trim("email")).alias("_e"), F.coalesce("verified", F.lit(False)).alias("verified"),
        F.regexp_replace("mx_server", "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]", "").alias("mx_server"),
        F.regexp_replace("error", "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]", "").alias("error"),
    ).dropDuplicates(["_e"])
    return fan_out(rows.withColumn("_e", F.lower(F.trim("email"))), answers, "_e").drop("_e")


def check_summary(rows: DataFrame, results: DataFrame) -> DataFrame:
    """Distinct addresses asked about: verified, failed, unchecked."""
    asked = rows.select(F.lower(F.trim("email")).alias("_e")).distinct()
    answered = results.groupBy(F.lower(F.trim("email")).alias("_e")).agg(F.max("verified").alias("verified"))
    return asked.join(answered, "_e", "left").agg(
        F.count(F.lit(1)).alias("addresses"), F.count_if("verified").alias("verified"),
        F.count_if(~F.col("verified")).alias("failed"), F.count_if(F.col("verified").isNull()).alias("unchecked"),
    )


def verification_rollup(verdicts: DataFrame) -> DataFrame:
    """Verified, catch-all and rejected addresses per business."""
    status = E.deliverability(F.col("verified"), F.col("error"))
    return verdicts.groupBy("business_id").agg(
        F.count_if(status == "valid").alias("email_verified_count"),
        F.count_if(status == "catch_all").alias("email_catch_all_count"),
        F.count_if(status.isin("invalid", "unknown")).alias("email_rejected_count"),
    )


def coverage_funnel(businesses: DataFrame, addresses: DataFrame) -> DataFrame:
    """Per tier and overall: businesses, with an address, addresses, with a decision maker too."""
    held = addresses.groupBy("business_id").agg(F.count(F.lit(1)).alias("_n"))
    joined = businesses.join(held.withColumnRenamed("business_id", "id"), "id", "left")
    has = F.col("_n").isNotNull()
    return joined.rollup("icp_tier").agg(
        F.count(F.lit(1)).alias("businesses"), F.count_if(has).alias("with_address"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("addresses"),
        F.count_if(has & F.col("decision_maker_name").isNotNull()).alias("with_person"),
    )
