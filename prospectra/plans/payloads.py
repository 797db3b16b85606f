"""Contact and campaign tables handed to the mail system."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.functions import emails as E
from prospectra.functions.identity import content_key, email_domain, first_and_rest, site_domain, stable_uuid
from prospectra.functions.text import as_text, non_empty_map
from prospectra.operators.match import find_or_create
from prospectra.plans.pool import person_for, primary_contact

DRAFT_NAMESPACE = "0f6b2c58-0f57-5d3c-9b0e-2d9c6a1d7e42"


def contact_rows(businesses: DataFrame, research: DataFrame, drafts: DataFrame, pool: DataFrame) -> DataFrame:
    """One row per address of a business: drafted ones first, then its own remaining pool addresses.

    ``skip_reason`` tells why an address is not imported: proven dead, or on a
    domain that is neither the site's, a selected address's, nor free mail.
    """
    facts = businesses.join(research, "business_id").join(drafts, "business_id") \
        .withColumn("_own", F.array_distinct(F.concat(
            F.array(site_domain("domain", "website")), F.transform("selected", email_domain)))) \
        .withColumn("_main", primary_contact(F.col("contacts")))
    picked = drafts.select("business_id", F.posexplode("selected").alias("pos", "email")) \
        .withColumn("is_drafted", F.lit(True)).withColumn("verified", F.lit(None).cast("boolean")) \
        .withColumn("verification_error", F.lit(None).cast("string"))
    rest = pool.select("business_id", "pos", F.trim("email").alias("email"),
                       F.lit(False).alias("is_drafted"), "verified", "verification_error") \
        .filter(F.col("email") != "")
    rows = picked.unionByName(rest).withColumn("_e", F.lower("email"))
    first = rows.groupBy("business_id", "_e").agg(F.min_by(
        F.struct("pos", "email", "is_drafted", "verified", "verification_error"), F.struct(~F.col("is_drafted"), "pos")).alias("_r")) \
        .select("business_id", "_r.*")
    joined = first.join(facts, "business_id")
    domain = email_domain("email")
    own = F.array_contains("_own", domain) & (domain != "")
    skip = F.when(F.col("is_drafted"), F.lit(None)) \
        .when(E.deliverability(F.col("verified"), F.col("verification_error")) == "invalid", "mailbox does not exist") \
        .when(~own & ~E.is_free_mail_domain(domain), "not this business's domain")
    who = person_for(F.col("email"), F.col("contacts"))
    person = F.when(who.isNotNull(), who["name"]).otherwise(F.coalesce(F.col("_main.name"), F.col("decision_maker_name")))
    title = F.when(who.isNotNull(), who["title"]).otherwise(F.coalesce(F.col("_main.title"), F.col("decision_maker_title")))
    given, family = first_and_rest(person)
    only_drafted = lambda c: F.when(F.col("is_drafted"), F.coalesce(c, F.lit(""))).otherwise("")
    fields = {
        "draft_subject": only_drafted(F.col("subject")), "draft_body": only_drafted(F.col("body")),
        "draft_rationale": only_drafted(F.col("rationale")),
        "research_hook": as_text(F.col("personalization_hook"), "string"),
        "research_confidence": as_text(F.col("confidence"), "double"),
        "research_pain_signals": as_text(F.col("pain_signals"), "array"),
        "business_website": as_text(F.col("website"), "string"), "business_city": as_text(F.col("city"), "string"),
        "business_icp_tier": as_text(F.col("icp_tier"), "string"),
        "business_icp_score": as_text(F.col("icp_score"), "int"),
        "decision_maker_title": as_text(title, "string"),
    }
    return joined.select(
        "business_id", "pos", "email", "is_drafted", skip.alias("skip_reason"),
        given.alias("first_name"), family.alias("last_name"),
        F.coalesce("name", F.lit("")).alias("company"), F.coalesce("phone", F.lit("")).alias("phone"),
        F.lit(True).alias("subscribed"), non_empty_map(fields).alias("custom_fields"),
    )


def drafted_only(pool: DataFrame, drafts: DataFrame) -> DataFrame:
    """Pool rows of the addresses a draft was written to."""
    chosen = drafts.select("business_id", F.explode("selected").alias("_s")) \
        .select("business_id", F.lower("_s").alias("_e")).distinct()
    return pool.withColumn("_e", F.lower(F.trim("email"))).join(chosen, ["business_id", "_e"], "left_semi").drop("_e")


def idempotency_keys(contacts: DataFrame) -> DataFrame:
    """Key per business: SHA-256 over the sorted SHA-256 values of its contacts, so their order does not matter.

    The values are joined per first two digits, then over those digits; no list holds a large business whole.
    """
    content = F.to_json(F.struct("email", "first_name", "last_name", "company", "phone", "custom_fields"))
    rows = contacts.filter(F.col("skip_reason").isNull()).select("business_id", F.sha2(content, 256).alias("_h"))
    joined = lambda c: F.sha2(F.array_join(F.array_sort(F.collect_list(c)), ""), 256)
    parts = rows.groupBy("business_id", F.left("_h", F.lit(2)).alias("_p")).agg(joined("_h").alias("_h"), F.count(F.lit(1)).alias("_n"))
    per = parts.groupBy("business_id").agg(joined(F.concat("_p", "_h")).alias("_h"), F.sum("_n").alias("contacts"))
    payload = F.col("_h")
    key = content_key(F.concat(F.lit("leads-business-"), F.col("business_id").cast("string")), payload)
    return per.select("business_id", "contacts", key.alias("idempotency_key"))


def draft_id(business_id: Column, email: Column) -> Column:
    """Stable id of the draft for one business and one address."""
    return stable_uuid(DRAFT_NAMESPACE, business_id.cast("string"), F.lower(F.trim(email)))


def campaigns(businesses: DataFrame, contacts: DataFrame, existing: DataFrame) -> DataFrame:
    """One campaign per business: reused by exact name, its first drafted address enrolled."""
    drafted = contacts.filter("is_drafted")
    first = drafted.groupBy("business_id").agg(
        F.min_by("email", "pos").alias("enrolled"), (F.count(F.lit(1)) - 1).alias("not_enrolled"))
    name = F.coalesce(F.nullif("name", F.lit("")), F.concat(F.lit("business "), F.col("business_id").cast("string")))
    wanted = businesses.select("business_id", name.alias("campaign_name"))
    found = find_or_create(wanted, existing, "campaign_name", "campaign_id")
    return found.join(first, "business_id", "left")
