"""Enrichment from the stored listing: booking evidence, review growth, description backfill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.functions.identity import none_if_blank
from prospectra.functions.reviews import growth, histogram_bucket, review_window
from prospectra.operators.merge import merge_upsert
from prospectra.operators.stage import staged

# Booking vendors by link pattern.
BOOKING_VENDORS = (
    (r"(?i)mindbody", "Mindbody"), (r"(?i)vagaro", "Vagaro"), (r"(?i)gingr", "Gingr"),
    (r"(?i)calendly", "Calendly"), (r"(?i)acuity|squarespace.*scheduling", "Acuity"),
    (r"(?i)jotform", "Jotform"), (r"(?i)typeform", "Typeform"),
    (r"(?i)square\.site|squareup", "Square"), (r"(?i)vetstoria", "Vetstoria"),
    (r"(?i)timify", "Timify"), (r"(?i)setmore", "Setmore"), (r"(?i)booksy", "Booksy"),
    (r"(?i)paw\s?partner|pawpartner", "PawPartner"),
    (r"(?i)precisepetcare", "PrecisePetCare"), (r"(?i)timetopet", "TimeToPet"),
)


def booking_evidence(order_online: Column) -> Column:
    """What shows that a listing takes bookings; NULL without any link (never a negative)."""
    links = F.filter(
        F.transform(order_online, lambda o: none_if_blank(o["link"])), lambda x: x.isNotNull()
    )
    blob = F.array_join(links, " ")
    vendors = F.array_distinct(F.filter(
        F.array(*[F.when(blob.rlike(p), name) for p, name in BOOKING_VENDORS]), lambda v: v.isNotNull()
    ))
    first_source = F.coalesce(none_if_blank(F.get(order_online, F.lit(0))["source"]), F.lit("own site"))
    return F.when(F.size(links) > 0, F.when(
        F.size(vendors) > 0, F.concat(F.lit("booking via "), F.array_join(vendors, ", "))
    ).otherwise(F.concat(F.lit("booking link on "), first_source)))


def derive(businesses: DataFrame, now: Column) -> DataFrame:
    """Rows for which at least one field could be derived."""
    dated = staged(businesses, {
        "_w": review_window(F.transform("user_reviews", lambda r: r["published_at"]), now),
        "_evidence": booking_evidence(F.col("order_online")),
    })
    grown = growth(F.col("_w.n"), F.col("_w.oldest"), F.col("_w.newest"), now)
    raw = none_if_blank(F.col("raw_description"))
    out = staged(dated.select("id", "description", "raw_description", "_w", "_evidence"), {
        "booking_present": F.when(F.col("_evidence").isNotNull(), True), "marketing_evidence": F.col("_evidence"),
        "growth_score": grown["growth_score"], "growth_signal": grown["growth_signal"],
        "description": F.when(F.coalesce(F.col("description"), F.lit("")) == "", raw),
    }, ("raw_description", "_w", "_evidence"))
    return out.filter(
        F.col("booking_present").isNotNull() | F.col("growth_score").isNotNull()
        | F.col("description").isNotNull()
    )


def apply(businesses: DataFrame, derived: DataFrame) -> DataFrame:
    """Derived values merged in: new ones win, a NULL never clobbers, a description is only filled."""
    return merge_upsert(
        businesses, derived.join(businesses.select("id"), "id", "left_semi"), ["id"],
        {"description": "keep_old"}, "coalesce_new",
    )


def growth_buckets(derived: DataFrame) -> DataFrame:
    """Growth scores in buckets of twenty."""
    low = histogram_bucket(F.col("growth_score"))
    high = F.when(low == 80, 100).otherwise(low + 19)
    label = F.concat_ws("-", low.cast("string"), high.cast("string"))
    return derived.filter(F.col("growth_score").isNotNull()).groupBy(label.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )
