"""Identity columns: hosts, registrable domains, phones, name keys, URLs, stable ids."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Legal suffixes that do not distinguish one business from another.
LEGAL_SUFFIXES = r"\b(llc|inc|corp|co)\b\.?"

# A URL split by one pattern both Java and RE2 accept: scheme, host, rest.
_URL = r"^(?i)(https?)://(?:[^/?#@]*@)?([a-z0-9._-]+)(:[0-9]+)?([/?#].*)?$"

_ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
_PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def none_if_blank(c: Column) -> Column:
    """NULL for an empty string."""
    return F.when(c != "", c)


def with_scheme(website: Column | str) -> Column:
    """The trimmed value, ``https://`` put in front when no web scheme is there."""
    raw = F.trim(_col(website))
    return F.when(raw.rlike("(?i)^https?://"), raw).otherwise(F.concat(F.lit("https://"), raw))


def host(website: Column | str, require_dot: bool = True, reject_ip: bool = False) -> Column:
    """Lower-case host without ``www.``; NULL when the value is not a URL."""
    found = F.lower(F.regexp_extract(with_scheme(website), _URL, 2))
    found = none_if_blank(F.regexp_replace(found, r"^www\.", ""))
    if require_dot:
        found = F.when(F.instr(found, ".") > 0, found)
    if reject_ip:
        found = F.when(~found.rlike(r"^[0-9.]+$"), found)
    return found


def last_labels(domain: Column | str, n: int = 2) -> Column:
    """The last ``n`` labels of a host."""
    return F.substring_index(F.lower(_col(domain)), ".", -n)


def registrable(website: Column | str) -> Column:
    """Two-label domain of a website value (an approximation on multi-part suffixes)."""
    return last_labels(host(website))


def same_site(a: Column | str, b: Column | str) -> Column:
    """True when both hosts share their last two labels; false when either is missing."""
    return F.coalesce(last_labels(a) == last_labels(b), F.lit(False))


def host_by_replace(website: Column | str) -> Column:
    """Host by stripping scheme, path and ``www.`` only; keeps whatever else is there."""
    bare = F.regexp_replace(_col(website), "^https?://", "")
    bare = F.regexp_replace(bare, "/.*$", "")
    return F.lower(F.regexp_replace(bare, r"^www\.", ""))


def phone_key(phone: Column | str) -> Column:
    """Digits only, a leading country 1 of eleven dropped; NULL below seven digits."""
    digits = F.regexp_replace(_col(phone), "[^0-9]", "")
    local = F.when(
        (F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)
    ).otherwise(digits)
    return F.when(F.length(local) >= 7, local)


def _squeeze(c: Column) -> Column:
    return F.regexp_replace(
        F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), LEGAL_SUFFIXES, ""), "[^a-z0-9]+", ""
    )


def name_key(name: Column | str, city: Column | str, state: Column | str) -> Column:
    """``name|city|state`` with legal suffixes and punctuation removed; NULL without a name."""
    parts = [_squeeze(_col(c)) for c in (name, city, state)]
    return F.when(parts[0] != "", F.concat_ws("|", *parts))


def file_slug(text: Column | str) -> Column:
    """Lower-case slug with underscores, at most 100 characters."""
    kept = F.regexp_replace(F.lower(F.trim(_col(text))), r"[^a-z0-9_\s-]", "")
    return F.substring(F.regexp_replace(kept, r"\s+", "_"), 1, 100)


def safe_name(text: Column | str, separator: str = "_") -> Column:
    """Accents folded, every other run of characters turned into one separator."""
    plain = F.translate(F.lower(_col(text)), _ACCENTED, _PLAIN)
    return F.regexp_replace(
        F.regexp_replace(plain, "[^a-z0-9]+", separator), f"^{separator}+|{separator}+$", ""
    )


def event_slug(event: Column | str) -> Column:
    """``EMAIL_SENT`` -> ``email-sent``."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(_col(event)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(slug != "", slug).otherwise(F.lit("event"))


def event_key(typed: Column | str) -> Column:
    """A typed event name in its canonical form: `` email-sent `` -> ``EMAIL_SENT``."""
    return F.upper(F.regexp_replace(F.trim(_col(typed)), r"[\s-]+", "_"))


def page_url(website: Column | str) -> Column:
    """Absolute URL with at least ``/`` as path; NULL when the host is not a domain."""
    full = with_scheme(website)
    rest = F.regexp_extract(full, _URL, 4)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    built = F.concat(
        F.lower(F.regexp_extract(full, _URL, 1)),
        F.lit("://"),
        F.regexp_extract(full, _URL, 2),
        F.regexp_extract(full, _URL, 3),
        rest,
    )
    return F.when(F.instr(F.regexp_extract(full, _URL, 2), ".") > 0, built)


def origin(url: Column | str) -> Column:
    """``scheme://host[:port]`` of an absolute URL, lower-cased."""
    c = _col(url)
    return F.when(
        c.rlike(_URL),
        F.lower(
            F.concat(
                F.regexp_extract(c, _URL, 1),
                F.lit("://"),
                F.regexp_extract(c, _URL, 2),
                F.regexp_extract(c, _URL, 3),
            )
        ),
    )


def url_path(url: Column | str) -> Column:
    """Path of an absolute URL, without query and fragment."""
    path = F.regexp_replace(F.regexp_extract(_col(url), _URL, 4), "[?#].*$", "")
    return F.when(path != "", path).otherwise(F.lit("/"))


def _collapse_dots(path: Column) -> Column:
    """``/a/./b/../c`` -> ``/a/c``."""
    return F.when(path.rlike(r"(?:^|/)\.{1,2}(?:/|$)"), _walk_dots(path)).otherwise(path)


def _walk_dots(path: Column) -> Column:
    walked = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda acc, part: F.when(
            part == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc)
        )
        .when(part == ".", acc)
        .otherwise(F.concat(acc, F.array(part))),
    )
    joined = F.array_join(walked, "/")
    joined = F.when(path.rlike(r"/\.{1,2}$"), F.concat(joined, F.lit("/"))).otherwise(joined)
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def resolve_url(href: Column | str, base: Column | str) -> Column:
    """An ``href`` made absolute against ``base``, fragment dropped; NULL when not a web URL."""
    parts = F.struct(
        F.regexp_replace(F.trim(_col(href)), "#.*$", "").alias("raw"),
        origin(base).alias("site"), url_path(base).alias("path"),
        F.regexp_extract(F.regexp_replace(_col(base), "#.*$", ""), r"(\?.*)$", 1).alias("query"),
    )

    def built(p: Column) -> Column:
        raw = p["raw"]
        own, query = F.regexp_replace(raw, r"\?.*$", ""), F.regexp_extract(raw, r"(\?.*)$", 1)
        folder = F.regexp_replace(p["path"], "[^/]*$", "")
        tail = F.regexp_extract(raw, r"(\?.*)$", 1)
        return (
            F.when(p["site"].isNull(), F.lit(None))
            .when(raw == "", F.concat(p["site"], p["path"], p["query"]))
            .when(raw.rlike("(?i)^https?://"), F.concat(origin(raw), url_path(raw), tail))
            .when(raw.rlike("(?i)^[a-z][a-z0-9+.-]*:"), F.lit(None))
            .when(raw.startswith("//"), let(
                F.concat(F.regexp_extract(p["site"], "^(https?:)", 1), raw),
                lambda full: F.concat(origin(full), url_path(full), tail)))
            .when(raw.startswith("?"), F.concat(p["site"], p["path"], raw))
            .when(raw.startswith("/"), F.concat(p["site"], _collapse_dots(own), query))
            .otherwise(F.concat(p["site"], _collapse_dots(F.concat(folder, own)), query))
        )

    return let(parts, built)


def email_domain(email: Column | str) -> Column:
    """Lower-case domain of an address, empty when it has none."""
    c = F.lower(F.trim(_col(email)))
    return F.when(F.instr(c, "@") > 0, F.substring_index(c, "@", -1)).otherwise(F.lit(""))


def site_domain(domain: Column | str, website: Column | str) -> Column:
    """The stored domain, else the website's host, without ``www.``."""
    stored = F.lower(F.trim(F.coalesce(_col(domain), F.lit(""))))
    own = F.when(stored != "", stored).otherwise(
        F.coalesce(host(website, require_dot=False), F.lit(""))
    )
    return F.regexp_replace(own, r"^www\.", "")


def stable_uuid(namespace: str, *parts: Column) -> Column:
    """Version-5 UUID of the parts joined with a colon, the same on every run."""
    ns = F.lit(bytearray(uuid.UUID(namespace).bytes))
    digest = F.sha1(F.concat(ns, F.concat_ws(":", *parts).cast("binary")))
    variant = F.substring(
        F.lit("89ab"), (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4) + 1, 1
    )
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def content_key(prefix: Column | str, payload: Column) -> Column:
    """``prefix-<16 hex digits of the payload's hash>``: same content, same key."""
    return F.concat(_col(prefix), F.lit("-"), F.substring(F.sha2(payload, 256), 1, 16))


def first_and_rest(name: Column | str) -> tuple[Column, Column]:
    """First word and everything after it, both empty for a blank name."""
    words = F.split(F.trim(F.coalesce(_col(name), F.lit(""))), r"\s+", 2)
    return words[0], F.coalesce(F.try_element_at(words, F.lit(2)), F.lit(""))


def provider_of(model: Column | str) -> Column:
    """Text before the first slash."""
    return F.split_part(_col(model), F.lit("/"), F.lit(1))


def model_family(model: Column | str) -> Column:
    """First token of the last path part, lower-cased."""
    last = F.substring_index(_col(model), "/", -1)
    return F.lower(F.regexp_extract(last, "^([^-:.]*)", 1))
