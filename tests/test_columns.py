"""Identity, address, date and text columns against worked examples (all names invented)."""

import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from prospectra.functions import emails as E, identity as I, reviews as R, text as T


@pytest.mark.parametrize("given, expected", [
    ("https://www.Acme.test/about", "acme.test"), ("(555) 123-4567", None), ("localhost", None),
    ("http://shop.acme.co.uk/", "shop.acme.co.uk"), ("acme.test", "acme.test"), (None, None), ("", None),
])
def test_host(value, given, expected):
    assert value(lambda c: I.host(c.cast("string")), given) == expected


def test_host_variants(value):
    assert value(lambda c: I.host(c, reject_ip=True), "192.168.1.1") is None
    assert value(I.registrable, "https://shop.acme.test") == "acme.test"
    assert value(lambda a, b: I.same_site(a, b), "mail.acme.test", "acme.test") is True


@pytest.mark.parametrize("given, expected", [
    ("(555) 123-4567", "5551234567"), ("+1 555 123 4567", "5551234567"), ("911", None),
])
def test_phone(value, given, expected):
    assert value(I.phone_key, given) == expected


def test_name_key(value):
    assert value(I.name_key, "Acme Dogs, LLC", "New York", "NY") == "acmedogs|newyork|ny"
    assert value(I.name_key, "LLC", "New York", "NY") is None


@pytest.mark.parametrize("href, base, expected", [
    ("/a/b", "https://x.test/p/q?z=1", "https://x.test/a/b"), ("c", "https://x.test/p/q", "https://x.test/p/c"),
    ("../c/./d", "https://x.test/p/q/r", "https://x.test/p/c/d"), ("?y=2", "https://x.test/p/q", "https://x.test/p/q?y=2"),
    ("#top", "https://x.test/p#a", "https://x.test/p"), ("//cdn.test/f", "https://x.test/", "https://cdn.test/f"),
    ("mailto:a@b.c", "https://x.test/", None), ("https://Y.test", "https://x.test/", "https://y.test/"),
])
def test_resolve_url(value, href, base, expected):
    assert value(I.resolve_url, href, base) == expected


def test_stable_uuid(value):
    namespace = "0f6b2c58-0f57-5d3c-9b0e-2d9c6a1d7e42"
    expected = str(uuid.uuid5(uuid.UUID(namespace), "7:a@x.test"))
    assert value(lambda a, b: I.stable_uuid(namespace, a, b), "7", "a@x.test") == expected


def test_addresses(value):
    assert value(E.addresses_in, "Contact bob@acme-dogs.test.") == ["bob@acme-dogs.test"]
    assert value(E.addresses_in, "(reach us: Sue@K9.test)") == ["sue@k9.test"]
    assert value(E.addresses_in, "a@x.test b@x.test A@x.test") == ["a@x.test", "b@x.test"]


@pytest.mark.parametrize("email, reason", [
    ("noreply@acme.test", "placeholder local part"), ("filler@godaddy.com", "placeholder local part"),
    ("x@mail.godaddy.com", "infrastructure domain"), ("0123456789abcdef@acme.test", "hex token"),
    ("12345@acme.test", "no letters in local part"), ("logo@2x.png", "asset filename"),
    ("erin@acme.test", None), ("a" * 41 + "@acme.test", "implausibly long local part"), ("@x.test", "malformed"),
])
def test_reject_reason(value, email, reason):
    assert value(E.reject_reason, email) == reason


@pytest.mark.parametrize("email, kind, points", [
    ("info@acme.test", "contact", 90), ("erin@acme.test", "contact", 100), ("erin@acme.test", "pricing", 93),
    ("pat@gmail.com", "contact", 65),
])
def test_confidence(spark, email, kind, points):
    df = spark.createDataFrame([(email, "https://www.acme.test", kind)], "email string, website string, kind string")
    c = E.address_classes("email", "website")
    got = df.select(E.address_confidence(c["is_role"], c["is_free_mail"], c["matches_site_domain"], F.col("kind"))).first()[0]
    assert got == points


@pytest.mark.parametrize("verified, error, expected", [
    (True, None, "valid"), (None, None, "unchecked"), (False, "false positive check failed for mx a", "catch_all"),
    (False, "5.1.1 gone", "invalid"), (False, "5.2.2 full", "invalid"), (False, "5.4.1 x", "invalid"),
    (False, "no MX record found", "invalid"), (False, "User unknown", "invalid"), (False, "5.7.1 blocked", "unknown"),
    (False, "connection closed", "unknown"), (False, "", "unknown"), (False, None, "unknown"),
])
def test_deliverability(value, verified, error, expected):
    assert value(lambda v, e: E.deliverability(v.cast("boolean"), e.cast("string")), verified, error) == expected


def growth(spark, dates, now):
    df = spark.createDataFrame([(dates,)], "d array<string>")
    moment = R.as_time(now)
    w = df.select(R.review_window(F.col("d"), moment).alias("w"))
    g = R.growth(F.col("w.n"), F.col("w.oldest"), F.col("w.newest"), moment)
    return w.select(*[c.alias(n) for n, c in g.items()]).first()


def test_growth(spark):
    dates = [f"2026-01-{d:02d}" for d in (1, 2, 3, 4, 4, 5, 5, 5)] + ["2030-01-01", "nonsense"]
    row = growth(spark, dates, "2026-01-15 00:00:00")
    assert row["growth_score"] == 100 and row["capped"]
    assert row["growth_signal"].startswith("8 recent reviews 2026-01-01..2026-01-05 (>=8.1/mo, newest 10d ago)")
    assert growth(spark, ["2026-01-01", "Jan 2, 2026"], "2026-01-15")["growth_score"] is None


def test_epochs(value):
    assert value(lambda c: F.unix_seconds(R.epoch_seconds(c)), "1690000000") == 1690000000
    assert value(R.epoch_seconds, "0") is None and value(R.epoch_seconds, "99999999999999") is None
    now = R.as_time("2026-09-19 12:00:00")
    assert value(lambda c: R.within_days(c.cast("timestamp"), now), "2026-08-21 12:00:00") is True
    assert value(lambda c: R.within_days(c.cast("timestamp"), now), "2026-08-19 12:00:00") is False


def test_html_to_text(value):
    html = ("<a href=\"mailto:Erin@x.test\">Mail</a><script>var a='<b>';</script><!-- no --><p>Tom&amp;Jerry&nbsp;"
            "&rsquo;s\x00</p><style>p{}</style>")
    assert value(T.html_to_text, html) == "erin@x.test Mail Tom&Jerry 's"
    assert value(T.decode_entities, "&#65;&amp;&#39;&lt;") == "A&'<"


def test_block_pages(value):
    body = "x" * 600
    assert value(lambda s, b, t: T.is_usable_page(s, b, t), 403, body, "403 Forbidden " + "y" * 500) is False
    assert value(lambda s, b, t: T.is_usable_page(s, b, t), 403, body, "Real prose " * 60) is True
    assert value(lambda s, b, t: T.is_usable_page(s, b, t), 200, "short", "t") is False


@pytest.mark.parametrize("text, found", [
    ("Hi [Your Name], ok", "[Your Name]"), ("Hi {{first_name}}", "{{first_name}}"), ("see [the services page especially]", None),
    ("<COMPANY> rocks", "<COMPANY>"), ("plain", None),
])
def test_placeholder(value, text, found):
    assert value(T.find_placeholder, text) == found


@pytest.mark.parametrize("body, found", [
    ("Hello there.\n\nThanks,", "Thanks,"), ("Body.\nMore.\nBest,\nNate", "Best,\nNate"),
    ("Thanks for reading this far.", None), ("Body.\nWant to talk?", None),
])
def test_sign_off(value, body, found):
    assert value(T.find_sign_off, body) == found


def failures(spark, body, subject="Hello"):
    from prospectra.plans.draft_qa import verdicts
    return verdicts(spark.createDataFrame([(subject, body)], "subject string, body string")).first()["failures"]


GOOD = ("I saw that your site lists private lessons and a puppy class but no way to book them online, and that costs you "
        "calls.\n\nWould a short list of owners asking for lessons near you be worth a look?")


def test_draft_failures(spark):
    assert failures(spark, GOOD) == []
    assert failures(spark, "") == ["empty_body"]
    assert failures(spark, GOOD[:-1] + " ต่อ") == ["unterminated_body", "non_latin_script"]
    assert failures(spark, GOOD + "\nThanks") == ["sign_off"]
    assert failures(spark, GOOD.replace("costs", "“costs” café —")) == []
    assert failures(spark, GOOD + " &amp; **bold** done.") == ["html_entity", "markdown"]


def test_mention_is_unknown_without_a_name(value):
    assert value(lambda b, n: T.draft_metrics(b, b, n.cast("string"))["mentions_business"], "x", None) is None


def test_content_key_is_sha256_prefix(value):
    expected = "k-" + hashlib.sha256(b"abc").hexdigest()[:16]
    assert value(lambda c: I.content_key(F.lit("k"), c), "abc") == expected


def test_route_ties_go_to_the_earlier(value):
    assert value(lambda c: T.keyword_route(c, T.ROUTES, "cheap"), "write sql") == "code"
    assert value(lambda c: T.keyword_route(c, T.ROUTES, "cheap"), "hello") == "cheap"


def test_decimal_references_beyond_one_byte(value):
    from prospectra.functions.text import decode_entities

    assert value(decode_entities, "It&#8217;s caf&#233; &#128054; &#039; &#55296; &#9999999;") == "It’s café \U0001f436 ' &#55296; &#9999999;"
