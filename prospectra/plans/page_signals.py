"""Marketing evidence on stored pages: detectors, per-business rollup, score, links to follow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.functions import emails as E
from prospectra.functions.identity import none_if_blank, origin, resolve_url, url_path
from prospectra.functions.markup import opened, tag_events, values_of
from prospectra.operators.quantiles import quantiles
from prospectra.operators.skew import first_non_null
from prospectra.operators.stage import staged
from prospectra.operators.topk import first_k

# Detector rules as (pattern, token). Inside a group the first match gives the token.
GOOGLE_ADS = (
    (r"(?i)gtag/js\?id=AW-", "gtag AW- conversion id"),
    (r"(?i)googleadservices\.com", "googleadservices.com"),
    (r"(?i)google_conversion_id", "google_conversion_id"),
    (r"(?i)\bAW-\d{9,}", "AW- conversion id"),
    (r"(?i)googleads\.g\.doubleclick\.net", "doubleclick ads"),
)
META_ADS = (
    (r"(?i)connect\.facebook\.net/[a-z_]+/fbevents\.js", "fbevents.js"),
    (r"(?i)\bfbq\s*\(\s*['\"]init['\"]", "fbq('init')"),
    (r"(?i)facebook\.com/tr\?id=", "facebook pixel tr?id"),
)
MARTECH = (
    (r"(?i)gtag/js\?id=G-|googletagmanager\.com/gtag/js\?id=G-", "GA4"),
    (r"(?i)googletagmanager\.com/gtm\.js|GTM-[A-Z0-9]{4,}", "Google Tag Manager"),
    (r"(?i)static\.hotjar\.com|hj\s*\(", "Hotjar"),
    (r"(?i)klaviyo\.com/onsite|klaviyo\.js", "Klaviyo"),
    (r"(?i)js\.hs-scripts\.com|hubspot", "HubSpot"),
    (r"(?i)mailchimp|mc\.us\d+\.list-manage\.com", "Mailchimp"),
    (r"(?i)cdn\.callrail\.com", "CallRail"),
    (r"(?i)tidio|intercom|drift\.com|tawk\.to", "live chat"),
    (r"(?i)snap\.licdn\.com", "LinkedIn insight tag"),
    (r"(?i)analytics\.tiktok\.com", "TikTok pixel"),
)
BOOKING = (
    (r"(?i)calendly\.com", "Calendly"),
    (r"(?i)acuityscheduling|squarespace\.com/scheduling", "Acuity"),
    (r"(?i)mindbodyonline|mindbody", "Mindbody"),
    (r"(?i)vagaro\.com", "Vagaro"),
    (r"(?i)gingrapp|gingr\.com", "Gingr"),
    (r"(?i)booksy\.com", "Booksy"),
    (r"(?i)setmore\.com", "Setmore"),
    (r"(?i)timetopet\.com", "TimeToPet"),
    (r"(?i)precisepetcare\.com", "PrecisePetCare"),
    (r"(?i)pawpartner|paw-?partner", "PawPartner"),
    (r"(?i)square\.site|squareup\.com/appointments", "Square Appointments"),
    (r"(?i)schedulicity|simplybook|appointy|bookeo", "scheduling widget"),
    (r"(?i)\b(?:book|schedule|request)\s+(?:a\s+)?(?:free\s+)?(?:consult(?:ation)?|evaluation|assessment|discovery call)\b",
     "book-a-consultation copy"),
)
FORM_EMBEDS = (
    (r"(?i)typeform\.com", "Typeform"),
    (r"(?i)jotform\.com", "Jotform"),
    (r"(?i)formstack|wufoo|gravityforms|formidable", "form builder"),
    (r"(?i)hsforms\.net|js\.hsforms", "HubSpot form"),
)
GROWTH = (
    ("hiring", r"(?i)\b(?:we(?:'re| are)\s+hiring|join\s+our\s+team|now\s+hiring|careers?)\b", "hiring copy"),
    ("multi_location",
     r"(?i)\b(?:our\s+locations|all\s+locations|choose\s+a\s+location|two\s+locations|second\s+location)\b",
     "multiple locations"),
    ("pricing_page", r"(?i)\b(?:pricing|our\s+rates|packages|program\s+pricing|tuition|investment)\b", "pricing/packages"),
    ("franchise", r"(?i)\bfranchis(?:e|ing)\b", "franchise"),
)
# Profile links as (name, must match, must not match).
PROFILES = (
    ("facebook", r"(?i)(?:^|//|\.)facebook\.com/", r"(?i)/(?:2008|sharer|share|plugins|tr\b|dialog|v\d)"),
    ("instagram", r"(?i)(?:^|//|\.)instagram\.com/[^/?#]+", None),
    ("youtube", r"(?i)youtube\.com/(?:c/|channel/|user/|@)", None),
    ("tiktok", r"(?i)tiktok\.com/@", None),
    ("linkedin", r"(?i)linkedin\.com/(?:in|company|pub)/", None),
    ("yelp", r"(?i)yelp\.com/biz/", None),
    ("twitter", r"(?i)(?:twitter\.com|(?:^|//)x\.com)/(?!intent|share|i/)[A-Za-z0-9._]+", None),
    ("google_business", r"(?i)(?:g\.page|goo\.gl/maps|google\.com/maps/place)", None),
)
NOT_A_PAGE = r"(?i)^(?:mailto:|tel:|javascript:|#)"
ASSET_LINK = r"(?i)\.(?:jpe?g|png|gif|webp|svg|pdf|css|js|zip|mp4|ico)(?:$|\?)"
# Sub-pages worth following, most valuable kind first.
SUBPAGE_KINDS = (
    ("about", r"(?i)/(?:about|our-story|who-we-are|meet|team|staff|trainers?|bios?)\b"),
    ("pricing", r"(?i)/(?:pricing|rates|packages|programs?|services|tuition)\b"),
    ("contact", r"(?i)/(?:contact|book|schedule|consultation|get-started)\b"),
)
FORM_TYPES = ("email", "tel")
FORM_NAME = r"(?i)email|phone|tel"
# Attributes that hold links, and all that the signals of a page are read from.
LINK_KEYS = ("href", "src", "content")
SIGNAL_KEYS = (*LINK_KEYS, "type", "name")
# Hosts that are a profile, not a site to visit.
SOCIAL_SITE = r"(?i)(?:facebook\.com|instagram\.com|nextdoor\.com|linktr\.ee)"


def first_token(html: Column, rules) -> Column:
    """Token of the first rule that matches, or NULL."""
    chain = F
    for pattern, token in rules:
        chain = chain.when(html.rlike(pattern), token)
    return chain.otherwise(F.lit(None))


def all_tokens(html: Column, rules) -> Column:
    """Tokens of every rule that matches, in rule order."""
    return F.filter(
        F.array(*[F.when(html.rlike(p), t) for p, t in rules]), lambda t: t.isNotNull()
    )


def profile_links(events: Column, longest: int | None = None) -> Column:
    """Profile name -> first link to it, looked for in attribute values only; ``longest`` cuts the links."""
    urls = values_of(events, *LINK_KEYS)

    def hit(must: str, never: str | None) -> Column:
        def test(u: Column) -> Column:
            return u.rlike(must) & ~u.rlike(never) if never else u.rlike(must)
        first = F.get(F.filter(urls, test), F.lit(0))
        return first if longest is None else F.left(first, F.lit(longest))

    pairs = [x for name, must, never in PROFILES for x in (F.lit(name), hit(must, never))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def has_contact_input(events: Column) -> Column:
    """True when a form of any length asks for an address or a phone number."""
    def asks(e: Column) -> Column:
        told = lambda k: F.coalesce(F.try_element_at(e["values"], F.lit(k)), F.lit(""))
        return (e["form"] >= 0) & (F.lower(told("type")).isin(*FORM_TYPES) | told("name").rlike(FORM_NAME))

    return F.exists(opened(events), asks)


def _first(items: Column, most: int | None) -> Column:
    return items if most is None else F.slice(items, 1, most)


def detect(pages: DataFrame, html: str = "html", per_page: tuple[int | None, int | None] = (5, 3)) -> DataFrame:
    """Adds what one page shows; a missing token means not observed here, nothing more.

    A page shows its first five addresses of persons and three of desks, by rule; ``per_page``
    takes other numbers, None for all.
    """
    h, e = F.col(html), F.col("_events")
    found = staged(pages, {"_events": tag_events(h, ("open",), keys=SIGNAL_KEYS), "_addresses": E.page_addresses(h)})
    people = F.filter("_addresses", E.is_person_shaped)
    desks = F.filter("_addresses", lambda e: ~E.is_person_shaped(e))
    return found.select(
        *pages.columns,
        first_token(h, GOOGLE_ADS).alias("google_ads"), first_token(h, META_ADS).alias("meta_ads"),
        all_tokens(h, MARTECH).alias("martech"), first_token(h, BOOKING).alias("booking"),
        F.coalesce(first_token(h, FORM_EMBEDS), F.when(has_contact_input(e), "native form with email/phone input")).alias("lead_form"),
        profile_links(e).alias("profiles"),
        all_tokens(h, [(p, k) for k, p, _ in GROWTH]).alias("growth"),
        _first(people, per_page[0]).alias("person_emails"), _first(desks, per_page[1]).alias("role_emails"),
    )


def _joined(label: str, items: Column) -> Column:
    return F.when(F.size(items) > 0, F.concat(F.lit(label), F.array_join(items, ", ")))


def roll_up(signals: DataFrame, key: str, page_order: str) -> DataFrame:
    """Signals of all pages of a business with the marketing score and its evidence.

    "First" follows ``page_order``; of several links to a profile the last page's counts. Only
    fixed vocabularies are gathered into arrays and maps; addresses, which have no bound, are rows
    of ``site_addresses``.
    """
    order = F.col(page_order)
    martech = [F.max(F.array_contains("martech", t)).alias(f"_m{i}") for i, (_, t) in enumerate(MARTECH)]
    growth = [F.max(F.array_contains("growth", k)).alias(f"_g{i}") for i, (k, _, _) in enumerate(GROWTH)]
    profiles = [
        F.max_by(F.col("profiles")[n], F.when(F.col("profiles")[n].isNotNull(), order)).alias(f"_p{i}")
        for i, (n, _, _) in enumerate(PROFILES)
    ]
    tokens = [first_non_null(F.col(c), order).alias(c) for c in ("google_ads", "meta_ads", "booking", "lead_form")]
    agg = signals.groupBy(key).agg(
        *tokens, *martech, *growth, *profiles, F.count(F.lit(1)).alias("pages"),
        F.max(F.size("person_emails") > 0).alias("has_person_email"),
        F.max(F.col("page_kind") == "about" if "page_kind" in signals.columns else F.lit(None).cast("boolean")).alias("has_about_page"),
    )

    def listed(prefix: str, labels: list[str], test) -> Column:
        return F.filter(
            F.array(*[F.when(test(F.col(f"{prefix}{i}")), n) for i, n in enumerate(labels)]), lambda x: x.isNotNull()
        )

    agg = agg.withColumn("martech", listed("_m", [t for _, t in MARTECH], lambda c: c)) \
        .withColumn("growth", listed("_g", [t for _, _, t in GROWTH], lambda c: c)) \
        .withColumn("profiles", listed("_p", [n for n, _, _ in PROFILES], lambda c: c.isNotNull())) \
        .withColumn("profile_urls", F.map_filter(F.create_map(*[x for i, (n, _, _) in enumerate(PROFILES) for x in (F.lit(n), F.col(f"_p{i}"))]), lambda _, v: v.isNotNull()))
    score = (
        F.when(F.col("google_ads").isNotNull(), 25).otherwise(0) + F.when(F.col("meta_ads").isNotNull(), 25).otherwise(0)
        + F.when(F.col("booking").isNotNull(), 15).otherwise(0) + F.when(F.col("lead_form").isNotNull(), 10).otherwise(0)
        + F.least(F.size("martech") * 4, F.lit(12)) + F.least(F.size("profiles") * 3, F.lit(12))
        + F.when(F.col("_g0"), 5).otherwise(0) + F.when(F.col("_g1"), 5).otherwise(0)
    )
    evidence = F.array_join(F.filter(F.concat(F.array(
        F.concat(F.lit("Google Ads ("), F.col("google_ads"), F.lit(")")),
        F.concat(F.lit("Meta Ads ("), F.col("meta_ads"), F.lit(")")),
        F.concat(F.lit("booking: "), F.col("booking")), F.concat(F.lit("lead form: "), F.col("lead_form")),
        _joined("martech: ", F.col("martech")), _joined("social: ", F.col("profiles")),
    ), F.col("growth")), lambda e: e.isNotNull()), "; ")
    return agg.select(
        key, "pages", (F.col("google_ads").isNotNull() | F.col("meta_ads").isNotNull()).alias("marketing_active"),
        F.col("google_ads").isNotNull().alias("google_ads_signal"), F.col("meta_ads").isNotNull().alias("meta_ads_signal"),
        F.col("lead_form").isNotNull().alias("lead_form_present"),
        F.when(F.col("booking").isNotNull(), True).alias("booking_present"),
        F.least(score, F.lit(100)).alias("marketing_score"), none_if_blank(evidence).alias("marketing_evidence"),
        "martech", "profiles", "profile_urls", "growth", "has_person_email", "has_about_page",
    )


def site_addresses(signals: DataFrame, key: str, page_order: str) -> DataFrame:
    """``key, email, person, first_page``: every address that the pages of a business show, a row each, however many."""
    both = F.concat(F.transform("person_emails", lambda e: F.struct(e.alias("email"), F.lit(True).alias("person"))),
                    F.transform("role_emails", lambda e: F.struct(e.alias("email"), F.lit(False).alias("person"))))
    return signals.select(key, F.col(page_order).alias("_page"), F.explode(both).alias("_a")).groupBy(key, "_a.email", "_a.person") \
        .agg(F.min("_page").alias("first_page"))


# Observed values are authoritative, except a booking link another channel may have seen.
ENTITY_POLICIES = {"booking_present": "coalesce_new", "marketing_evidence": "coalesce_new"}


def coverage(rolled: DataFrame) -> DataFrame:
    """Share of reachable businesses per signal."""
    def share(cond: Column) -> Column:
        return F.round(F.lit(100.0) * F.count_if(cond) / F.greatest(F.count(F.lit(1)), F.lit(1)), 1)

    return rolled.agg(
        F.count(F.lit(1)).alias("reachable"), share(F.col("marketing_active")).alias("pct_pixel"),
        share(F.col("booking_present").isNotNull()).alias("pct_booking"),
        share(F.col("lead_form_present")).alias("pct_form"), share(F.col("has_person_email")).alias("pct_person_email"),
        share(F.col("has_about_page")).alias("pct_about"),
    )


def social_breadth(rolled: DataFrame, reviews: DataFrame, key: str) -> DataFrame:
    """Businesses and median reviews by number of linked platforms."""
    per = rolled.select(key, F.size("profiles").alias("breadth")).join(reviews, key)
    counts = per.groupBy("breadth").agg(F.count(F.lit(1)).alias("businesses"))
    return counts.join(quantiles(per, ["breadth"], "review_count", [0.5]).withColumnRenamed("q0", "median_reviews"), "breadth", "left")


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Every link of a page made absolute, in page order."""
    hrefs = values_of(tag_events(html, ("open",), keys=("href",)), "href")
    rest = [c for c in pages.columns if c != html]
    resolved = F.transform(hrefs, lambda h: F.struct(h.alias("href"), resolve_url(h, url).alias("target")))
    return pages.select(*rest, F.posexplode(resolved).alias("pos", "_l")) \
        .select(*rest, "pos", F.col("_l.href").alias("href"), F.col("_l.target").alias("target"))


def subpages(pages: DataFrame, key: str, url: str = "url", html: str = "html", k: int = 3) -> DataFrame:
    """Up to ``k`` same-origin sub-pages per page: about before pricing before contact."""
    kind, rank = F, F
    for i, (name, pattern) in enumerate(SUBPAGE_KINDS):
        kind = kind.when(url_path("target").rlike(pattern), name)
        rank = rank.when(url_path("target").rlike(pattern), i)
    found = links(pages.select(key, url, html), url, html) \
        .filter(~F.col("href").rlike(NOT_A_PAGE) & ~F.col("href").rlike(ASSET_LINK)) \
        .filter(origin("target") == origin(url)) \
        .withColumn("kind", kind.otherwise(F.lit(None))).withColumn("kind_rank", rank.otherwise(F.lit(None))) \
        .filter(F.col("kind").isNotNull()) \
        .withColumn("_same", F.regexp_replace("target", "/$", ""))
    once = found.groupBy(key, "_same", "kind", "kind_rank").agg(F.min(F.struct("pos", "target")).alias("_f")) \
        .select(key, "kind", "kind_rank", "_f.pos", F.col("_f.target").alias("subpage"))
    return first_k(once, [key], [F.col("kind_rank"), F.col("pos")], k)


def crawl_eligible(
    businesses: DataFrame, categories: list[str] | None = None, tiers: list[str] | None = None,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Businesses with a site of their own that were not rejected; listed ids skip the other filters."""
    if ids is not None:
        return businesses.join(ids, "id", "left_semi")
    keep = (F.coalesce("website", F.lit("")) != "") & ~F.col("website").rlike(SOCIAL_SITE) & (F.col("qc_status") != "REJECTED")
    if categories:
        keep = keep & F.col("service_category").isin(*categories)
    if tiers:
        keep = keep & F.col("icp_tier").isin(*tiers)
    return businesses.filter(keep)


def crawl_gaps(businesses: DataFrame, crawl: DataFrame, second: DataFrame | None = None) -> DataFrame:
    """Businesses without any page text, or with a page that failed; those done by the second crawler drop out."""
    has_text = F.coalesce("text", F.lit("")) != ""
    failed = F.col("fetch_error").isNotNull() | F.col("http_status").isNull() | ~F.col("http_status").between(200, 399)
    state = crawl.groupBy(F.col("business_id").alias("id")).agg(
        F.max(has_text).alias("_text"), F.max(failed).alias("_failed")
    )
    gaps = businesses.join(state, "id", "left").filter(
        ~F.coalesce("_text", F.lit(False)) | F.coalesce("_failed", F.lit(False))
    ).drop("_text", "_failed")
    if second is None:
        return gaps
    done = second.filter(has_text).select(F.col("business_id").alias("id"))
    return gaps.join(done, "id", "left_anti")


def cut_off_texts(pages: DataFrame, cap: int, before) -> DataFrame:
    """Pages fetched before a date whose text is exactly as long as the old limit."""
    return pages.filter((F.length("text") == cap) & (F.col("fetched_at") < before))
