"""Outreach candidates: eligibility, nested evidence, gaps, claims, outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.operators.merge import merge_upsert
from prospectra.operators.skew import pack_rows
from prospectra.operators.topk import budget, latest

STALE_CLAIM_HOURS = 6


def latest_verdicts(verdicts: DataFrame) -> DataFrame:
    """Newest check result per stored address, with its error."""
    return latest(verdicts, ["business_email_id"], "verified_at", ["verified", "error"]) \
        .withColumnRenamed("error", "verification_error")


def is_stale_claim(status: Column, claimed_at: Column, now: Column, hours: int = STALE_CLAIM_HOURS) -> Column:
    """True for a claim so old that its run must have died."""
    return (status == "claimed") & (claimed_at < now - F.make_dt_interval(F.lit(0), F.lit(hours)))


def open_to_claim(status: Column, claimed_at: Column, now: Column) -> Column:
    """True when nothing stands against taking a business: no row, failed, or a stale claim."""
    return status.isNull() | (status == "failed") | is_stale_claim(status, claimed_at, now)


def eligible(
    businesses: DataFrame, addresses: DataFrame, pages: DataFrame, tiers: list[str],
    state: DataFrame | None = None, now: Column | None = None, limit: int | None = None,
    ids: DataFrame | None = None, exclude: DataFrame | None = None,
) -> DataFrame:
    """Businesses of the tiers with an address and page text, not yet processed, best first.

    Listed ids are taken as they are: naming a business is a decision.
    """
    if ids is not None:
        return businesses.join(ids, "id", "left_semi")
    chosen = businesses.filter(F.col("icp_tier").isin(*tiers))
    if exclude is not None:
        chosen = chosen.join(exclude, "id", "left_anti")
    if state is not None:
        taken = state.filter(~open_to_claim(F.col("status"), F.col("claimed_at"), now))
        chosen = chosen.join(taken.select(F.col("business_id").alias("id")), "id", "left_anti")
    with_text = pages.filter(F.coalesce("text", F.lit("")) != "").select(F.col("business_id").alias("id"))
    chosen = chosen.join(addresses.select(F.col("business_id").alias("id")), "id", "left_semi") \
        .join(with_text, "id", "left_semi")
    if limit is None:
        return chosen
    return budget(chosen, [
        F.col("icp_score").desc_nulls_last(), F.col("review_count").desc_nulls_last(), F.col("id")
    ], limit)


def address_rows(chosen: DataFrame, addresses: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Addresses of the chosen businesses with their newest verdict; never checked stays NULL."""
    held = addresses.withColumnRenamed("business_id", "id").join(chosen.select("id"), "id", "left_semi")
    return held.join(latest_verdicts(verdicts), "business_email_id", "left")


def context_blocks(chosen: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """Page texts of both crawlers as labelled blocks, whole, in reading order columns."""
    both = first.withColumn("crawler", F.lit(1)).unionByName(second.withColumn("crawler", F.lit(2)))
    text = F.trim("text")
    label = F.concat(
        F.lit("--- "), F.coalesce(F.nullif("page_kind", F.lit("")), F.lit("page")), F.lit(": "), F.col("url"), F.lit(" ---\n")
    )
    return both.withColumnRenamed("business_id", "id").join(chosen.select("id"), "id", "left_semi") \
        .filter(F.coalesce(text, F.lit("")) != "") \
        .select("id", "crawler", "page_kind", "fetched_at", "url", F.concat(label, text).alias("block"))


def research_context(blocks: DataFrame, max_blocks: int = 200) -> DataFrame:
    """Blocks of a business joined in order; a business with very many pages gives several parts, which follow each other."""
    packed = pack_rows(blocks, ["id"], ["crawler", "page_kind", "fetched_at", "url"], ["block"], "blocks", max_blocks)
    return packed.select(
        "id", F.col("chunk").alias("part"), F.size("blocks").alias("pages"),
        F.array_join(F.transform("blocks", lambda b: b["block"]), "\n\n").alias("context"),
    )


def nested(chosen: DataFrame, held: DataFrame, max_items: int = 10_000) -> DataFrame:
    """Chosen businesses with their addresses as an array of structs (part 0 for nearly all)."""
    fields = ["email", "source", "confidence", "is_role", "verified", "verification_error"]
    packed = pack_rows(held, ["id"], ["email"], fields, "emails", max_items)
    return chosen.join(packed, "id", "left")


def gap_flags(chosen: DataFrame, held: DataFrame, second: DataFrame) -> DataFrame:
    """Per business: does an address lack a verdict, is there no second-crawl page."""
    unchecked = held.groupBy("id").agg(F.max(F.col("verified").isNull()).alias("needs_verification"))
    read = second.filter(F.coalesce("text", F.lit("")) != "") \
        .select(F.col("business_id").alias("id")).distinct().withColumn("_read", F.lit(True))
    return chosen.select("id").join(unchecked, "id", "left").join(read, "id", "left").select(
        "id", F.coalesce("needs_verification", F.lit(False)).alias("needs_verification"),
        F.col("_read").isNull().alias("needs_second_crawl"),
    )


def claim(state: DataFrame, wanted: DataFrame, run_id: str, now: Column, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """(granted ids, state after the claim).

    One writer at a time: the state must be written before the next claim reads it.
    """
    current = wanted.select("business_id").distinct().join(state, "business_id", "left")
    granted = current if force else current.filter(open_to_claim(F.col("status"), F.col("claimed_at"), now))
    granted = granted.select("business_id")
    fresh = granted.select(
        "business_id", F.lit("claimed").alias("status"), F.lit(None).cast("string").alias("reason"),
        F.lit(run_id).alias("run_id"), now.alias("claimed_at"), F.lit(None).cast("timestamp").alias("finished_at"),
    )
    return granted, merge_upsert(state, fresh, ["business_id"])


UNAVAILABLE = "llm_unavailable"


def outcome_status(c: dict[str, Column]) -> dict[str, Column]:
    """Final state and reason of one business: imported, rejected (final) or failed (retryable).

    ``c`` holds import_status, research_status, draft_status, error, rejection_reason,
    draft_reason, import_error and import_reason.
    """
    reason = F.coalesce(F.nullif(c["rejection_reason"], F.lit("")), c["research_status"])
    imported = F.coalesce(c["import_status"] == "imported", F.lit(False))
    errored = F.coalesce(c["research_status"] == "error", F.lit(False)) | F.coalesce(c["draft_status"] == "error", F.lit(False))
    unresearched = F.coalesce(c["research_status"] != "researched", F.lit(False))
    undrafted = F.coalesce((c["draft_status"] != "") & (c["draft_status"] != "drafted"), F.lit(False))
    draft_down = F.coalesce(c["draft_reason"] == UNAVAILABLE, F.lit(False))
    status = (
        F.when(imported, "imported").when(errored, "failed")
        .when(unresearched, F.when(reason == UNAVAILABLE, "failed").otherwise("rejected"))
        .when(undrafted, F.when(draft_down, "failed").otherwise("rejected")).otherwise("failed")
    )
    why = (
        F.when(imported, F.lit(None)).when(errored, c["error"]).when(unresearched, reason)
        .when(undrafted, F.when(draft_down, f"draft {UNAVAILABLE}").otherwise(F.concat(F.lit("draft "), c["draft_status"])))
        .when(c["import_status"].isNotNull(), F.coalesce(
            F.nullif(c["import_error"], F.lit("")), F.nullif(c["import_reason"], F.lit("")), F.lit("import failed")))
        .otherwise("did not finish")
    )
    return {"status": status, "reason": why}


def failure_reason(is_transport: Column) -> Column:
    """Why a model call gave nothing: no answer (retryable) or an answer off schema."""
    return F.when(is_transport, UNAVAILABLE).otherwise("llm_schema_failure")


def record_outcomes(state: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """State rows after their outcomes; businesses without a row are left out."""
    cols = outcome_status({c: F.col(c) for c in (
        "import_status", "research_status", "draft_status", "error", "rejection_reason",
        "draft_reason", "import_error", "import_reason")})
    done = outcomes.select("business_id", cols["status"].alias("status"), cols["reason"].alias("reason"), now.alias("finished_at"))
    return merge_upsert(state, done.join(state.select("business_id"), "business_id", "left_semi"), ["business_id"])


def tallies(outcomes: DataFrame) -> DataFrame:
    """Counts of a finished run in one row."""
    r, d, i = F.col("research_status"), F.col("draft_status"), F.col("import_status")
    return outcomes.agg(
        F.count(F.lit(1)).alias("selected"), F.count_if(r == "researched").alias("researched"),
        F.count_if(r == "rejected").alias("rejected"), F.count_if(d == "drafted").alias("drafted"),
        F.count_if(i == "imported").alias("imported"),
        F.count_if(i.isNotNull() & (i != "imported")).alias("import_failed"),
        F.count_if((r == "error") | (d == "error")).alias("errored"),
    )
