"""Contacts from stored domain-registration documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.functions import emails as E
from prospectra.functions.identity import registrable
from prospectra.operators.match import fan_out
from prospectra.operators.merge import insert_absent, merge_upsert
from prospectra.operators.stage import staged

# Wording of privacy and proxy services.
PRIVACY = (
    r"(?i)domains?\s?by\s?proxy|whoisguard|privacy\s?-?\s?guardian|privacyguardian|privacyprotect"
    r"|privacy\s?protect|withheld\s?for\s?privacy|contact\s?privacy|perfect\s?privacy"
    r"|identity\s?protect|privacy\s?service|private\s?by\s?design|super\s?privacy|whois\s?privacy"
    r"|whoisprivacy|whoisprotection|data\s?protected|domain\s?protection|proxy\s?protection|redacted"
    r"|not\s?disclosed|statutory\s?masking|gdpr\s?masked|jewellaprivacy|anonymize"
    r"|protecteddomainservices|namecheap\.com|withheldforprivacy|privatename|private\s?name"
    r"|pendingrenewalordeletion|registrant\s?of\b"
)
# Shapes of machine-made forwarding addresses.
PROXY_LOCAL = (
    r"(?i)^(?:pwp[-_]|reg[-_]\d|whois[-_]|priv[-_]|proxy[-_]|dm[-_][0-9a-f]{8}|[0-9a-f]{24,}$"
    r"|[a-z]{1,4}[-_][0-9a-f]{16,}$)|[-_]registrant$|^registrant[-_]"
)
# Domains that only receive proxied mail.
PROXY_DOMAIN = (
    r"(?i)(?:^|\.)(?:anonymised\.email|anonymize\.com|domain-contact\.org|domainsbyproxy\.com"
    r"|whoisguard\.com|withheldforprivacy\.com|privacyguardian\.org|whoisprotection\.cc"
    r"|privacyprotect\.org|contactprivacy\.com|identity-protect\.org|privatewhois\.\w+"
    r"|bluehostprivatename\.com|privatename\.com|namecheap\.com|perfectprivacy\.com"
    r"|networksolutionsprivateregistration\.com|tieredaccess\.com|protecteddomainservices\.com"
    r"|privacyadvocate\.org)$"
)
# Agencies and hosts that register domains for their clients.
VENDOR_DOMAIN = (
    r"(?i)(?:^|\.)(?:weebly\.com|wix\.com|squarespace\.com|godaddy\.com|imatrix\.com|milesit\.com"
    r"|web\.com|networksolutions\.com|register\.com|hostgator\.com|bluehost\.com|siteground\.com"
    r"|hostinger\.com|ionos\.com|1and1\.com|dreamhost\.com|inmotionhosting\.com|webmasters?\.com)$"
)
# Mailboxes of older access providers.
LEGACY_MAIL_DOMAIN = (
    r"(?i)(?:^|\.)(?:netzero\.com|pacbell\.net|qwest\.net|juno\.com|roadrunner\.com|rr\.com"
    r"|optonline\.net|windstream\.net|frontier\.com|centurylink\.net|ameritech\.net|swbell\.net"
    r"|prodigy\.net|mindspring\.com|peoplepc\.com)$"
)
# Desks of the registrar itself.
REGISTRAR_LOCALS = (
    "abuse", "compliance", "registrar", "whois", "whoisrequest", "whois-request", "legal",
    "support", "noc", "hostmaster", "postmaster", "admin-c", "dnsadmin",
)
# Profile hosts that are nobody's own site.
PLATFORM_HOST = (
    r"(?i)(?:^|\.)(?:instagram|facebook|fb|linkedin|twitter|x|tiktok|youtube|yelp|google"
    r"|sites\.google|wixsite|weebly|squarespace|godaddysites|business\.site|linktr|beacons|carrd"
    r"|bio\.link|about\.me|nextdoor|rover|wagwalking)\.(?:com|ee|be|me|ai|co|link)$"
)
# Registrars that never publish a registrant.
NO_YIELD_REGISTRAR = (
    r"(?i)(?:^|\.)(?:godaddy|wildwestdomains|namecheap|squarespace|wix|dynadot|spaceship|cloudflare"
    r"|names4ever|ionos|markmonitor)(?:\.|$)"
)
ROLE_ORDER = ("registrant", "administrative", "technical")
CONTACT_ROLES = (*ROLE_ORDER, "abuse")

DOCUMENT = (
    "struct<entities:array<struct<roles:array<string>,vcardArray:array<string>>>,"
    "links:array<struct<href:string>>>"
)


def _fields(entity: Column) -> Column:
    """Card fields of an entity as arrays of text."""
    return F.coalesce(
        F.from_json(F.get(entity["vcardArray"], F.lit(1)), "array<array<string>>"),
        F.array().cast("array<array<string>>"),
    )


def _named(fields: Column, names: tuple[str, ...]) -> Column:
    return F.transform(F.filter(fields, lambda f: F.get(f, F.lit(0)).isin(*names)), lambda f: F.get(f, F.lit(3)))


def _verdict(email: Column, proxied: Column, domain: Column) -> Column:
    local = F.substring_index(email, "@", 1)
    masked = (
        proxied | email.rlike(PRIVACY) | local.rlike(PROXY_LOCAL) | (local == F.lower(domain))
        | F.substring_index(email, "@", -1).rlike(PROXY_DOMAIN)
    )
    return F.when(F.lower(local).isin(*REGISTRAR_LOCALS), "junk") \
        .when(F.coalesce(masked, F.lit(False)), "privacy").otherwise("found")


def contacts(documents: DataFrame) -> DataFrame:
    """Outcome, address and registrant of each (domain, document): found, privacy, junk or redacted."""
    doc = documents.select("domain", F.from_json("document", DOCUMENT).alias("_d"))
    entities = F.coalesce("_d.entities", F.array().cast("array<struct<roles:array<string>,vcardArray:array<string>>>"))
    shaped = F.transform(entities, lambda e: F.struct(
        F.transform(F.coalesce(e["roles"], F.array().cast("array<string>")), F.lower).alias("roles"),
        F.coalesce(F.get(e["vcardArray"], F.lit(1)).rlike(PRIVACY), F.lit(False)).alias("proxied"),
        F.transform(_named(_fields(e), ("email",)), lambda x: F.lower(F.trim(x))).alias("emails"),
        F.array_join(_named(_fields(e), ("fn", "org")), " / ").alias("who"),
    ))
    wanted = F.array(*[F.lit(r) for r in CONTACT_ROLES])
    doc = staged(doc, {"_c": F.filter(shaped, lambda c: F.arrays_overlap(c["roles"], wanted))}, ("_d",))
    in_order = F.flatten(F.transform(
        F.array(*[F.lit(r) for r in ROLE_ORDER]),
        lambda role: F.filter(F.col("_c"), lambda c: F.array_contains(c["roles"], role)),
    ))
    doc = staged(doc, {"_o": in_order}, ("_c",))
    judged = F.flatten(F.transform("_o", lambda c: F.transform(c["emails"], lambda e: F.struct(
        e.alias("email"), c["who"].alias("who"), _verdict(e, c["proxied"], F.col("domain")).alias("verdict")
    ))))
    doc = staged(doc, {"_j": judged})
    hit = F.get(F.filter("_j", lambda j: j["verdict"] == "found"), F.lit(0))
    private = F.exists("_o", lambda c: c["proxied"]) | F.exists("_j", lambda j: j["verdict"] == "privacy")
    junk = F.exists("_j", lambda j: j["verdict"] == "junk")
    outcome = F.when(hit.isNotNull(), "found").when(private, "privacy").when(junk, "junk").otherwise("redacted")
    who = F.when(hit["who"] != "", hit["who"])
    return staged(doc, {"outcome": outcome, "email": hit["email"], "registrant": who}, ("_o", "_j"))


def registrar_link(document: Column, registry_base: Column | None = None) -> Column:
    """The registrar's own lookup address a registry record points at, or NULL."""
    links = F.transform(F.from_json(document, DOCUMENT)["links"], lambda x: x["href"])
    ok = F.filter(links, lambda h: h.rlike("(?i)^https://") & h.rlike("(?i)rdap"))
    if registry_base is not None:
        ok = F.filter(ok, lambda h: ~F.lower(h).startswith(F.lower(registry_base)))
    return F.get(ok, F.lit(0))


def local_names_registrant(email: Column, registrant: Column) -> Column:
    """True when some part of the local part, three letters or more, stands in the registrant's name."""
    local = F.trim(F.regexp_replace(F.lower(F.substring_index(email, "@", 1)), "[._-]+", " "))
    parts = F.split(local, r"\s+")
    hit = F.exists(parts, lambda p: (F.length(p) >= 3) & F.contains(F.lower(registrant), p))
    return F.coalesce((F.length(local) >= 3) & hit, F.lit(False))


def accept(found: DataFrame) -> DataFrame:
    """Judges found addresses (domain, website, email, registrant): accepted ones get a confidence."""
    classes = E.address_classes("email", "website")
    df = staged(found, {f"email_{n}" if n == "domain" else n: c for n, c in classes.items()})
    own = F.col("matches_site_domain")
    theirs = local_names_registrant(F.col("email"), F.col("registrant")) & ~F.col("email_domain").rlike(VENDOR_DOMAIN)
    consumer = F.col("is_free_mail") | F.col("email_domain").rlike(LEGACY_MAIL_DOMAIN)
    vendor = ~own & ~theirs & (F.col("email_domain").rlike(VENDOR_DOMAIN) | ~consumer)
    reason = F.coalesce(E.reject_reason("email"), F.when(vendor, "third-party vendor domain"))
    points = F.lit(35) + F.when(F.col("is_role"), 0).otherwise(10) + F.when(F.col("is_free_mail"), -5).otherwise(5)
    return df.withColumn("reason", reason).withColumn(
        "confidence", F.when(F.col("reason").isNull(), F.least(F.lit(60), points))
    ).withColumn("outcome", F.when(F.col("reason").isNull(), "found").otherwise("junk"))


def targets(businesses: DataFrame, answered: DataFrame, registrars: Column | None = None) -> DataFrame:
    """Domains still to ask about, with how many businesses hold each: no address yet, own site, not answered."""
    open_ = businesses.filter(
        (F.col("qc_status") != "REJECTED") & F.col("contact_email").isNull() & F.col("website").isNotNull()
    ).withColumn("domain", registrable("website"))
    usable = open_.filter(F.col("domain").isNotNull() & ~F.col("domain").rlike(PLATFORM_HOST))
    return usable.groupBy("domain").agg(
        F.min("website").alias("website"), F.count(F.lit(1)).alias("holders")
    ).join(answered, "domain", "left_anti")


def store(
    businesses: DataFrame, stored_addresses: DataFrame, stored_probes: DataFrame,
    judged: DataFrame, probes: DataFrame,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Probes, addresses and entities after a run; an address already known is never replaced.

    An entity without an address gets the registry's, how many there are and whether it is a desk's;
    one that has an address keeps all three. Addresses carry ``source_url`` if ``judged`` has it.
    """
    link = F.col("source_url") if "source_url" in judged.columns else F.lit(None).cast("string").alias("source_url")
    holders = businesses.select(F.col("id").alias("business_id"), registrable("website").alias("domain"))
    accepted = judged.filter(F.col("reason").isNull())
    fanned = fan_out(holders.filter(F.col("domain").isNotNull()), accepted.select(
        "domain", "email", "local_part", "email_domain", "is_role", "is_free_mail", "matches_site_domain", "confidence", link,
    ), "domain")
    addresses = insert_absent(stored_addresses, fanned.select(
        "business_id", "email", "local_part", F.col("email_domain").alias("domain"),
        F.lit("rdap").alias("source"), "source_url", "is_role", "is_free_mail", "matches_site_domain", "confidence",
    ), ["business_id", "email"])
    best = fanned.groupBy(F.col("business_id").alias("id")).agg(
        F.min("email").alias("contact_email"), F.count_distinct("email").cast("int").alias("contact_email_count"),
        F.min_by("is_role", "email").alias("contact_email_is_role"))
    without = businesses.filter(F.col("contact_email").isNull()).select("id")
    entities = merge_upsert(businesses, best.join(without, "id", "left_semi"), ["id"], default="overwrite")
    return merge_upsert(stored_probes, probes, ["domain"]), addresses, \
        entities.join(businesses.select("id"), "id", "left_semi")
