"""Rule scoring: category gate, premium wording, reputation steps, spend signals, tiers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.functions.emails import clamp
from prospectra.functions.identity import let
from prospectra.operators.diff import differs
from prospectra.operators.stage import staged

# Listing category -> service line.
CATEGORY_SERVICE = {
    "dog trainer": "dog_training",
    "pet trainer": "dog_training",
    "dog day care center": "daycare_boarding",
    "pet boarding service": "daycare_boarding",
    "kennel": "daycare_boarding",
    "cat boarding service": "daycare_boarding",
    "pet groomer": "grooming",
    "pet grooming station": "grooming",
    "dog walker": "dog_walking_petsitting",
    "pet sitter": "dog_walking_petsitting",
    "pet care service": "dog_walking_petsitting",
    "veterinarian": "veterinary",
    "animal hospital": "veterinary",
    "veterinary care": "veterinary",
    "emergency veterinarian service": "veterinary",
    "pet hospital": "veterinary",
    "veterinary clinic": "veterinary",
    "pet supply store": "pet_retail",
    "pet store": "pet_retail",
    "pet insurance": "pet_insurance",
    "pet health insurance": "pet_insurance",
}
# Primary categories that rule a record out.
DISQUALIFYING = (
    "animal shelter", "animal control service", "animal protection organization",
    "pet adoption service", "dog breeder", "non-profit organization",
    "dog park", "park", "state park", "public beach",
)
PET_PRIMARY = r"(?i)\b(dog|pet|puppy|canine|k-?9)\b"
STANDALONE_SERVICES = ("veterinary", "pet_retail", "pet_insurance")
# Service lines in priority order, and their base scores.
SERVICE_PRIORITY = (
    "dog_training", "daycare_boarding", "pet_insurance", "veterinary",
    "grooming", "pet_retail", "dog_walking_petsitting",
)
BASE_SCORE = {
    "dog_training": 55, "daycare_boarding": 45, "grooming": 35, "dog_walking_petsitting": 25,
    "veterinary": 55, "pet_retail": 25, "pet_insurance": 45,
}
# Wording that signals a premium service.
PREMIUM_SIGNALS = (
    (r"(?i)board.{0,5}(and|&|n).{0,5}train|\bb&t\b", 12, "board-and-train"),
    (r"(?i)aggress|reactiv|behavio(u)?r modification|behavio(u)?rist", 10, "behavior/aggression specialist"),
    (r"(?i)private (dog )?(train|lesson)|one.on.one|in.home train", 8, "private/in-home training"),
    (r"(?i)puppy (program|class|training|kindergarten)", 6, "puppy program"),
    (r"(?i)service dog|therapy dog|working dog|protection (dog|train)", 8, "specialty/working dog"),
    (r"(?i)mobile (groom|pet)", 8, "mobile grooming"),
    (r"(?i)luxury|premium|resort|suite|boutique", 5, "premium positioning"),
    (r"(?i)daycare|day care|overnight|boarding", 4, "recurring daycare/boarding"),
)
# Fixed values: (rating, reviews, points), best step first.
REPUTATION_STEPS = ((4.6, 270, 20), (4.6, 125, 14), (4.5, 55, 8), (4.0, 20, 4))
TIER_CUTOFFS = (83, 70, 50)

# Directory category tags -> service line, and the same tags -> listing category.
DIRECTORY_SERVICE = {
    "dog-training": "dog_training", "dog-day-care": "daycare_boarding",
    "pet-boarding-kennels": "daycare_boarding", "kennels": "daycare_boarding",
    "mobile-pet-grooming": "grooming", "pet-grooming": "grooming",
    "veterinary-clinics-hospitals": "veterinary", "veterinary-services": "veterinary",
    "animal-hospitals": "veterinary", "veterinarians": "veterinary",
    "pet-insurance": "pet_insurance", "pet-stores": "pet_retail",
    "pet-supply-stores": "pet_retail", "pet-supplies": "pet_retail",
}
DIRECTORY_PRIMARY = (
    ("dog trainer", ("dog-training",)),
    ("pet boarding service", ("dog-day-care", "pet-boarding-kennels", "kennels")),
    ("pet groomer", ("mobile-pet-grooming", "pet-grooming")),
    ("veterinarian", ("veterinary-clinics-hospitals", "veterinary-services", "animal-hospitals", "veterinarians")),
    ("pet store", ("pet-stores", "pet-supply-stores", "pet-supplies")),
    ("pet insurance", ("pet-insurance",)),
)


def literal_map(values: Mapping) -> Column:
    """A constant map column."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def lookup(values: Mapping, key: Column) -> Column:
    """Constant-map lookup, NULL for an unknown key."""
    return F.try_element_at(literal_map(values), key)


def best_service(services: Column, priority: tuple[str, ...] = SERVICE_PRIORITY) -> Column:
    """The highest-priority service of an array, or NULL."""
    order = F.array(*[F.lit(s) for s in priority])
    ranks = F.filter(
        F.transform(services, lambda s: F.array_position(order, s).cast("int")),
        lambda r: r > 0,
    )
    return F.get(order, F.array_min(ranks) - 1)


def service_category(primary: Column, categories: Column, pet_primary: str = PET_PRIMARY) -> Column:
    """Service line of a business from its own categories; NULL when it is not a prospect."""
    first = F.lower(F.coalesce(primary, F.lit("")))
    others = F.transform(F.coalesce(categories, F.array().cast("array<string>")), F.lower)
    mapped = F.filter(
        F.transform(F.concat(F.array(first), others), lambda c: lookup(CATEGORY_SERVICE, c)),
        lambda s: s.isNotNull(),
    )
    own = lookup(CATEGORY_SERVICE, first)
    return F.when(first.isin(*DISQUALIFYING), F.lit(None)).otherwise(F.coalesce(own, let(mapped, lambda m: F.when(
        first.rlike(pet_primary) | F.exists(m, lambda s: s.isin(*STANDALONE_SERVICES)), best_service(m)
    ))))


def directory_service(categories: Column, ranked_by_priority: bool = True) -> Column:
    """Service line of a directory listing from its category tags."""
    mapped = F.transform(categories, lambda c: lookup(DIRECTORY_SERVICE, c))
    return best_service(F.filter(mapped, lambda s: s.isNotNull()))


def directory_primary(categories: Column) -> Column:
    """Listing category a directory listing comes closest to (any tag of a row counts)."""
    chain = F
    for name, tags in DIRECTORY_PRIMARY:
        chain = chain.when(F.arrays_overlap(categories, F.array(*[F.lit(t) for t in tags])), name)
    return chain.otherwise("pet care service")


def tier(score: Column, cutoffs: tuple[int, int, int] = TIER_CUTOFFS) -> Column:
    """Tier 1 to 4 by descending cutoffs."""
    chain = F
    for i, cutoff in enumerate(cutoffs):
        chain = chain.when(score >= cutoff, f"Tier {i + 1}")
    return chain.otherwise("Tier 4")


def about_options(about: Column) -> Column:
    """Names of the enabled options of all sections."""
    return F.flatten(F.transform(F.coalesce(about, F.array().cast(about_type())), lambda s: F.transform(
        F.filter(
            F.coalesce(s["options"], F.array().cast("array<struct<name:string,enabled:boolean>>")),
            lambda o: o["name"].isNotNull() & (o["name"] != "") & F.coalesce(o["enabled"], F.lit(True)),
        ),
        lambda o: o["name"],
    )))


def about_type() -> str:
    """Type of the nested option sections."""
    return "array<struct<options:array<struct<name:string,enabled:boolean>>>>"


# Inputs a caller may leave out; they then count as unknown.
OPTIONAL_INPUTS = {
    "keyword": "string", "description": "string", "about": "array<string>", "price_range": "string",
    "booking_present": "boolean", "growth_score": "int",
    "ads_confirmed_active": "boolean", "ads_creative_count": "int",
}


def score(df: DataFrame, cutoffs: tuple[int, int, int] = TIER_CUTOFFS, prefix: str = "") -> DataFrame:
    """Adds ``icp_score``, ``icp_tier``, ``qc_status``, ``derived_service`` and ``signals``.

    Needs name, primary_category, categories, rating, review_count and website.
    Unknown enrichment never lowers a score.
    """
    def c(name: str) -> Column:
        if name in df.columns:
            return F.col(name)
        return F.lit(None).cast(OPTIONAL_INPUTS[name])

    service = service_category(F.col("primary_category"), F.col("categories"))
    # Fields are joined with newlines, so no phrase can straddle two of them.
    blob = F.lower(F.concat_ws(
        "\n", F.col("name"), F.col("primary_category"), F.col("categories"), c("description"), c("about"),
    ))
    texts = staged(df, {"_service": service, "_blob": blob})
    judged = staged(texts, {f"_sig{i}": F.col("_blob").rlike(p) for i, (p, _, _) in enumerate(PREMIUM_SIGNALS)}, ("_blob",))
    hits = [F.col(f"_sig{i}") for i in range(len(PREMIUM_SIGNALS))]
    rating, reviews = F.col("rating"), F.col("review_count")
    has_site = F.coalesce(F.col("website"), F.lit("")) != ""
    reputation = F
    for stars, count, points in REPUTATION_STEPS:
        reputation = reputation.when((rating >= stars) & (reviews >= count), points)
    echoed = F.lit(False)
    for hit, (pattern, _, _) in zip(hits, PREMIUM_SIGNALS):
        echoed = echoed | (hit & F.coalesce(c("keyword"), F.lit("")).rlike(pattern))
    active = F.coalesce(c("ads_confirmed_active"), F.lit(False))
    creatives = F.coalesce(c("ads_creative_count"), F.lit(0))
    thin = (F.coalesce(reviews, F.lit(0)) < 3) & ~has_site
    total = (
        lookup(BASE_SCORE, F.col("_service"))
        + sum((F.when(h, pts).otherwise(0) for h, (_, pts, _) in zip(hits, PREMIUM_SIGNALS)), F.lit(0))
        + F.when(echoed, 5).otherwise(0)
        + reputation.otherwise(0)
        + F.when(has_site, 4).otherwise(0)
        + F.when(F.coalesce(c("price_range"), F.lit("")) != "", 5).otherwise(0)
        + F.when(F.coalesce(c("booking_present"), F.lit(False)), 8).otherwise(0)
        + F.when(F.coalesce(c("growth_score"), F.lit(0)) >= 60, 8).otherwise(0)
        + F.when(active, F.when(creatives >= 10, 16).otherwise(12)).when(creatives > 0, 4).otherwise(0)
        - F.when(thin, 20).otherwise(0)
    )
    points = F.when(F.col("_service").isNull(), 0).otherwise(clamp(total)).cast("int")
    named = F.filter(F.array(
        *[F.when(h, label) for h, (_, _, label) in zip(hits, PREMIUM_SIGNALS)],
        F.when(active, "confirmed ad spend (last 30d)"),
        F.when(active & (creatives >= 10), "multiple concurrent creatives"),
        F.when(~active & (creatives > 0), "lapsed ad spend"),
    ), lambda s: s.isNotNull())
    off = F.col("_service").isNull()
    scored = staged(judged, {f"{prefix}icp_score": points, f"{prefix}signals": F.when(
        off, F.array(F.lit("off-ICP category"))).otherwise(named)}, tuple(f"_sig{i}" for i in range(len(hits))))
    out_score = F.col(f"{prefix}icp_score")
    status = (
        F.when(off, "REJECTED")
        .when(~has_site & (F.coalesce(reviews, F.lit(0)) == 0), "NEEDS_ENRICHMENT")
        .when(out_score < 30, "LOW_PRIORITY")
        .otherwise("VALID")
    )
    return (
        scored.withColumn(f"{prefix}icp_tier", F.when(off, "Tier 4").otherwise(tier(out_score, cutoffs)))
        .withColumn(f"{prefix}qc_status", status)
        .withColumn(f"{prefix}derived_service", F.col("_service"))
        .drop("_service")
    )


def rescore_changes(businesses: DataFrame, cutoffs: tuple[int, int, int] = TIER_CUTOFFS) -> DataFrame:
    """Rows whose stored score, tier, status or service differ from a fresh scoring.

    The search keyword takes no part, and a rejected row keeps the service it was found under.
    """
    fresh = score(businesses.drop("keyword"), cutoffs, prefix="new_")
    kept = F.coalesce(F.col("new_derived_service"), F.col("service_category"))
    return fresh.withColumn("new_service_category", kept).filter(differs([
        (F.col("icp_score"), F.col("new_icp_score")),
        (F.col("icp_tier"), F.col("new_icp_tier")),
        (F.col("qc_status"), F.col("new_qc_status")),
        (F.col("service_category"), F.col("new_service_category")),
    ]))
