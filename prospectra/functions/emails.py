"""Addresses in text: extraction, reject reasons, classes, confidence, deliverability."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from prospectra.functions.identity import _col, email_domain, host, same_site

# An address in running text. The top-level domain must be alphabetic.
ADDRESS = (
    r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?"
    r"(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?)*\.[A-Za-z]{2,24}"
)
LOOSE_ADDRESS = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
TRAILING_PUNCTUATION = "[.,;:)\\]}>'\"]+$"

# Local parts nobody reads.
PLACEHOLDER_LOCALS = (
    "noreply", "no-reply", "donotreply", "do-not-reply", "filler", "example", "test", "user",
    "username", "email", "youremail", "name", "firstname", "lastname", "johnsmith", "janedoe",
    "abc", "xxx", "yourname", "someone",
)

# Domains of platforms and templates, never a business's own.
INFRASTRUCTURE_DOMAINS = (
    "sentry.io", "sentry.wixpress.com", "wixpress.com", "wix.com", "squarespace.com",
    "godaddy.com", "example.com", "example.org", "example.net", "domain.com", "email.com",
    "yourdomain.com", "yoursite.com", "sentry-next.wixpress.com", "schema.org", "w3.org",
    "googleapis.com", "gstatic.com", "cloudflare.com", "jquery.com", "bootstrapcdn.com",
    "fontawesome.com", "placeholder.com", "test.com", "website.com", "company.com",
    "business.com", "mysite.com",
)

# File endings that show an "address" is an asset name.
ASSET_NAME = r"(?i)\.(?:png|jpe?g|gif|webp|svg|ico|css|js|woff2?|ttf|eot|mp4|webm|pdf|zip)$"

# Shared inboxes.
ROLE_LOCALS = (
    "info", "contact", "hello", "hi", "admin", "office", "support", "help", "sales", "team",
    "mail", "email", "enquiry", "enquiries", "inquiry", "inquiries", "booking", "bookings",
    "book", "schedule", "training", "service", "services", "general", "reception", "frontdesk",
    "front-desk", "customerservice", "care", "woof", "bark", "dogs", "pets",
)

# First labels of consumer mail providers.
FREE_MAIL_LABELS = (
    "gmail", "googlemail", "yahoo", "ymail", "hotmail", "outlook", "live", "msn", "aol",
    "icloud", "me", "mac", "comcast", "verizon", "att", "sbcglobal", "bellsouth", "cox",
    "charter", "earthlink", "protonmail", "proton", "gmx", "mail", "zoho", "yandex",
)

# Whole consumer mail domains, used when judging a pool of addresses.
FREE_MAIL_DOMAINS = (
    "gmail.com", "googlemail.com", "yahoo.com", "ymail.com", "hotmail.com", "outlook.com",
    "live.com", "msn.com", "icloud.com", "me.com", "mac.com", "aol.com", "comcast.net",
    "att.net", "sbcglobal.net", "verizon.net", "protonmail.com", "proton.me", "gmx.com",
    "mail.com", "zoho.com",
)

# Confidence points by kind of page.
PAGE_KIND_POINTS = {"contact": 20, "about": 16, "home": 12, "pricing": 8}
OTHER_PAGE_POINTS = 6


def local_part(email: Column | str) -> Column:
    """Everything before the first ``@``."""
    return F.substring_index(_col(email), "@", 1)


def tidy_address(raw: Column) -> Column:
    """Lower-cased, punctuation that clung to the end removed."""
    return F.regexp_replace(F.lower(raw), TRAILING_PUNCTUATION, "")


def _all_in(text: Column, pattern: str) -> Column:
    """All matches; texts without an ``@`` skip the pattern."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(F.contains(text, F.lit("@")), found).otherwise(F.array().cast("array<string>"))


def addresses_in(text: Column | str) -> Column:
    """Distinct tidy addresses in first-seen order, nothing rejected yet."""
    return F.array_distinct(F.transform(_all_in(_col(text), ADDRESS), tidy_address))


def loose_addresses_in(text: Column | str) -> Column:
    """Every address-like token, with repeats, for counting rejects."""
    return F.transform(_all_in(_col(text), LOOSE_ADDRESS), tidy_address)


def stated_addresses(*texts: Column) -> Column:
    """Distinct lower-case addresses stated in any of the texts."""
    found = [F.transform(_all_in(F.coalesce(t, F.lit("")), LOOSE_ADDRESS), F.lower) for t in texts]
    return F.array_distinct(F.concat(*found))


def on_domain_list(domain: Column, domains: tuple[str, ...]) -> Column:
    """True for a listed domain or any subdomain of one."""
    escaped = "|".join(d.replace(".", r"\.") for d in domains)
    return domain.rlike(rf"(?i)(?:^|\.)(?:{escaped})$")


def reject_reason(email: Column | str, junk_domains: tuple[str, ...] = INFRASTRUCTURE_DOMAINS) -> Column:
    """First rule an address breaks, or NULL when it is kept."""
    c = _col(email)
    local = F.lower(local_part(c))
    domain = F.substring(c, F.instr(c, "@") + 1, F.length(c))
    return (
        F.when(F.instr(c, "@") < 2, "malformed")
        .when(c.rlike(ASSET_NAME), "asset filename")
        .when(local.isin(*PLACEHOLDER_LOCALS), "placeholder local part")
        .when(on_domain_list(domain, junk_domains), "infrastructure domain")
        .when(F.length(local) > 40, "implausibly long local part")
        .when(F.length(c) > 254, "exceeds maximum email length")
        .when(local.rlike("^[0-9a-f]{16,}$"), "hex token")
        .when(~local.rlike("[a-z]"), "no letters in local part")
    )


def is_role(email: Column | str) -> Column:
    """True for a shared inbox."""
    return F.lower(local_part(email)).isin(*ROLE_LOCALS)


def is_free_mail(domain: Column) -> Column:
    """True when the domain's first label is a consumer provider."""
    return F.split_part(F.lower(domain), F.lit("."), F.lit(1)).isin(*FREE_MAIL_LABELS)


def is_free_mail_domain(domain: Column) -> Column:
    """True for a whole consumer mail domain."""
    return F.lower(domain).isin(*FREE_MAIL_DOMAINS)


def address_classes(email: Column | str, website: Column | str) -> dict[str, Column]:
    """Local part, domain and the three class flags of one address."""
    domain = email_domain(email)
    return {
        "local_part": local_part(email),
        "domain": domain,
        "is_role": is_role(email),
        "is_free_mail": is_free_mail(domain),
        "matches_site_domain": same_site(domain, host(website)),
    }


def page_points(page_kind: Column) -> Column:
    """Confidence points for the kind of page an address stands on."""
    chain = F
    for kind, points in PAGE_KIND_POINTS.items():
        chain = chain.when(page_kind == kind, points)
    return chain.otherwise(OTHER_PAGE_POINTS)


def clamp(value: Column, low: int = 0, high: int = 100) -> Column:
    """Value held between two bounds, NULL staying NULL."""
    return F.when(value.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), value)))


def address_confidence(is_role_: Column, is_free: Column, own_domain: Column, page_kind: Column) -> Column:
    """0-100: how likely this is the right address to write to."""
    score = (
        F.lit(40)
        + F.when(own_domain, 30).when(~is_free, 5).otherwise(0)
        + F.when(is_role_, 0).otherwise(15)
        - F.when(is_free, 10).otherwise(0)
        + page_points(page_kind)
    )
    return clamp(score)


# Mailbox-check answers that prove a mailbox dead, or prove nothing.
DEAD_STATUS = r"^\s*5\.(?:1\.\d+|2\.\d+|4\.1)\b"
DEAD_PHRASES = (
    r"(?i)no mx record|invalid email format|does not exist|no such user|user unknown|unknown user"
    r"|mailbox not found|recipient not found"
)
CATCH_ALL_PHRASE = "false positive check failed"
STATUS_NOTES = {
    "valid": "the mailbox accepted it",
    "catch_all": "the domain accepts any address, so unconfirmed",
    "unknown": "the check did not finish",
    "unchecked": "not checked",
    "invalid": "the mailbox does not exist",
}


def deliverability(verified: Column, error: Column) -> Column:
    """valid, unchecked, catch_all, invalid or unknown. Only invalid speaks against a mailbox."""
    text = F.coalesce(error, F.lit(""))
    return (
        F.when(verified.isNull(), "unchecked")
        .when(verified, "valid")
        .when(F.contains(text, F.lit(CATCH_ALL_PHRASE)), "catch_all")
        .when(text.rlike(DEAD_STATUS) | text.rlike(DEAD_PHRASES), "invalid")
        .otherwise("unknown")
    )


def describe_address(email: Column, verified: Column, error: Column, role: Column, own_domain: Column) -> Column:
    """One line: the address, what the check found, what kind of inbox it is."""
    status = deliverability(verified, error)
    notes = F.create_map(*[F.lit(x) for pair in STATUS_NOTES.items() for x in pair])
    domain = email_domain(email)
    foreign = (own_domain != "") & (domain != "") & (domain != own_domain) & ~is_free_mail_domain(domain)
    parts = F.array(
        F.concat(status, F.lit(": "), F.element_at(notes, status)),
        F.when(role, "shared inbox").when(~role, "a person's own address"),
        F.when(foreign, "not on their website's domain"),
    )
    return F.concat(email, F.lit(" ("), F.concat_ws("; ", parts), F.lit(")"))


def normalise_list(emails: Column) -> Column:
    """Trimmed, lower-cased, blanks dropped, distinct in order."""
    tidy = F.transform(emails, lambda e: F.lower(F.trim(F.coalesce(e, F.lit("")))))
    return F.array_distinct(F.filter(tidy, lambda e: e != ""))


# Role words used when splitting a page's addresses into people and desks.
DESK_LOCALS = (
    "info", "contact", "hello", "admin", "office", "support", "sales", "team", "help",
    "booking", "bookings", "book", "inquiries", "inquiry", "enquiries", "training",
    "mail", "email", "service", "services", "customer", "schedule", "scheduling",
    "reservations", "frontdesk", "front", "general", "questions", "appointments",
    "noreply", "no-reply", "webmaster", "billing", "accounts", "hr", "jobs", "careers",
)
PAGE_ADDRESS = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.(?:com|net|org|co|io|us|biz)\b"
NOT_A_BUSINESS_ADDRESS = (
    r"(?i)(?:sentry|wixpress|example\.|godaddy|squarespace|jquery|schema\.org|w3\.org|shopify|sentry\.io)"
)


def page_addresses(html: Column) -> Column:
    """Distinct business addresses anywhere in a page's markup."""
    found = F.filter(
        _all_in(html, PAGE_ADDRESS),
        lambda e: ~e.rlike(NOT_A_BUSINESS_ADDRESS) & ~e.rlike(r"(?i)\.(?:png|jpe?g|gif|webp|svg)$"),
    )
    return F.array_distinct(F.transform(found, F.lower))


def is_person_shaped(email: Column) -> Column:
    """True for a local part that looks like somebody's name."""
    local = F.regexp_replace(local_part(email), r"\d+$", "")
    named = local.rlike("^[a-z]{2,}(?:[._-][a-z]+)?$") | local.rlike("^[a-z][._-][a-z]{2,}$")
    return ~local.isin(*DESK_LOCALS) & named
