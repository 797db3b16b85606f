"""Jobs against worked examples (all names and addresses invented)."""

import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from prospectra.functions.reviews import as_time
from prospectra.plans import ads, candidates, evidence, forms, health, ingest, people, pool, qc, registration, scoring
from prospectra.plans.page_signals import detect, roll_up
from prospectra.schemas import BUSINESS, EVENT
from prospectra.sources import places, reader, tables
from prospectra.streaming import events as ev


def scored(spark, **fields):
    base = dict(name="x", primary_category=None, categories=[], rating=None, review_count=None, website=None)
    row = base | fields
    schema = "name string, primary_category string, categories array<string>, rating double, review_count int, website string"
    extra = {k: v for k, v in row.items() if k not in base}
    df = spark.createDataFrame([tuple(row[k] for k in base)], schema)
    for k, v in extra.items():
        df = df.withColumn(k, F.lit(v).cast(scoring.OPTIONAL_INPUTS[k]))
    r = scoring.score(df).first()
    return r["icp_score"], r["icp_tier"], r["qc_status"], r["derived_service"]


def test_scores(spark):
    assert scored(spark, name="Acme Board and Train", primary_category="Dog trainer", categories=["Dog trainer"],
                  rating=4.8, review_count=300, website="https://a.test") == (91, "Tier 1", "VALID", "dog_training")
    assert scored(spark, primary_category="Pet boarding service", categories=["Pet boarding service", "Dog day care center"]) \
        == (29, "Tier 4", "NEEDS_ENRICHMENT", "daycare_boarding")
    assert scored(spark, primary_category="Dog park")[:3] == (0, "Tier 4", "REJECTED")
    assert scored(spark, primary_category="Hospital", categories=["Veterinarian"])[3] == "veterinary"
    assert scored(spark, primary_category="Pet service", categories=["Dog trainer"])[3] == "dog_training"
    assert scored(spark, primary_category="Training center", categories=["Dog trainer"])[2] == "REJECTED"


def test_unknown_ads_are_not_penalised(spark):
    base = dict(primary_category="Dog trainer", website="https://a.test")
    assert scored(spark, **base) == scored(spark, **base, ads_confirmed_active=False, ads_creative_count=0)


def page(spark, text, kind="about", url="https://x.test/about"):
    return spark.createDataFrame([(1, 1, url, kind, text)], "business_id int, page_seq int, url string, page_kind string, text string")


PAD = " We are a small place with many kind people in it and more."


@pytest.mark.parametrize("text, kind, expected", [
    ("Ana Ruiz-Kline (Owner) KPA-CTP" + PAD, "about", [("Ana Ruiz-Kline", "Owner", "high")]),
    ("My name is Dale Hurst and I train." + PAD, "about", [("Dale Hurst", "Owner", "low")]),
    ("My name is Dale Hurst and I train." + PAD, "pricing", []),
    ("Founder and veterinarian Dr. Ian Dorn sees them." + PAD, "about", [("Ian Dorn", "Founder", "medium")]),
    ("Every dog owner loves it. The pet owners and their owner agree." + PAD, "about", []),
    ("Jo Satter Vice President of sales spoke." + PAD, "about", []),
    ("As Featured In Client Sam Cole Meet the Founder today." + PAD, "home", []),
    ("Lisa, Owner of it all." + PAD, "about", []),
    ("we stayed at Pet Harmony, Owner said so" + PAD, "about", []),
    ("Jamie Miller Miller, Owner" + PAD, "about", []),
    ("Officer David Shade, Founder" + PAD, "about", [("David Shade", "Founder", "high")]),
])
def test_person_candidates(spark, text, kind, expected):
    got = people.candidates(page(spark, text, kind))
    assert [(r["name"], r["title"], r["confidence"]) for r in got.collect()] == expected


def choose(spark, pages, mails=()):
    df = spark.createDataFrame(pages, "business_id int, page_seq int, url string, page_kind string, text string")
    m = spark.createDataFrame([(1, x) for x in mails], "business_id int, email string")
    return [(r["name"], r["title"], r["confidence"]) for r in people.pick_decision_maker(people.score_people(people.candidates(df), m)).collect()]


def test_co_owner_is_junior_and_ties_choose_nobody(spark):
    both = "Val Frye Owner / CEO. She has run the place for twenty years. Kei Tuck Co-Owner / CFO also." + PAD
    assert [c[0] for c in choose(spark, [(1, 1, "https://x.test/a", "home", both)])] == ["Val Frye"]
    titles = {r["name"]: r["title"] for r in people.candidates(page(spark, both)).collect()}
    assert titles["Kei Tuck"] == "Co-owner"
    tie = "Ann Bell, Owner of it. And also Cal Dean, Owner of it." + PAD
    assert choose(spark, [(1, 1, "https://x.test/a", "home", tie)]) == []


def test_staff_page_and_mail_corroboration(spark):
    text = "Ann Bell, Owner of it." + PAD
    assert choose(spark, [(1, 1, "https://x.test/our-team", "home", text)]) == [("Ann Bell", "Owner", "low")]
    medium = "Ann Bell is the founder of it." + PAD
    for local in ("ann.bell", "abell"):
        assert choose(spark, [(1, 1, "https://x.test/a", "home", medium)], [f"{local}@x.test"]) == [("Ann Bell", "Founder", "high")]
    assert choose(spark, [(1, 1, "https://x.test/a", "home", medium)], ["zed@x.test"]) == [("Ann Bell", "Founder", "medium")]


def test_quote_is_verbatim(spark):
    text = "x " * 90 + "Ann Bell, Owner of it." + PAD * 3
    quote = people.candidates(page(spark, text)).first()["evidence_quote"]
    assert quote in text and "Ann Bell, Owner" in quote


def registration_outcome(spark, entities, domain="acme.test"):
    doc = json.dumps({"entities": entities, "links": [{"href": "https://rdap.r.test/d"}]})
    r = registration.contacts(spark.createDataFrame([(domain, doc)], "domain string, document string")).first()
    return r["outcome"], r["email"], r["registrant"]


def card(role, mail, name="Jo Lane"):
    return {"roles": [role], "vcardArray": ["vcard", [["version", {}, "text", "4.0"], ["fn", {}, "text", name], ["email", {}, "text", mail]]]}


def test_registration_outcomes(spark):
    assert registration_outcome(spark, [])[0] == "redacted"
    assert registration_outcome(spark, [card("registrant", "x@y.test", "Domains By Proxy")])[0] == "privacy"
    assert registration_outcome(spark, [card("abuse", "abuse@r.test")])[0] == "redacted"
    assert registration_outcome(spark, [card("technical", "abuse@r.test")])[0] == "junk"
    assert registration_outcome(spark, [card("registrant", "a@b.test", "Redacted"), card("technical", "jo@acme.test")])[:2] == ("found", "jo@acme.test")
    assert registration_outcome(spark, [card("technical", "t@h.test"), card("registrant", "Jo@acme.test")]) == ("found", "jo@acme.test", "Jo Lane")
    assert registration_outcome(spark, [card("registrant", "reg_21375@z.test")])[0] == "privacy"
    assert registration_outcome(spark, [card("registrant", "acme.test@fwd.test")])[0] == "privacy"


@pytest.mark.parametrize("email, registrant, points, reason", [
    ("jo@acme.test", None, 50, None), ("info@acme.test", None, 40, None), ("jo@gmail.com", None, 40, None),
    ("buy@itshop.test", "Jo Lane", None, "third-party vendor domain"), ("robert@other.test", "Lane, Robert", 50, None),
    ("robert@wix.com", "Robert", None, "infrastructure domain"), ("jo@netzero.com", None, 50, None),
])
def test_registration_acceptance(spark, email, registrant, points, reason):
    df = spark.createDataFrame([("acme.test", "https://acme.test", email, registrant)], "domain string, website string, email string, registrant string")
    r = registration.accept(df).first()
    assert (r["confidence"], r["reason"]) == (points, reason)


def test_ads(spark):
    def ad(first, last, fmt):
        return {"1": "AR1", "2": "CR", "4": fmt, "6": {"1": first}, "7": {"1": last}, "12": "Acme", "14": "acme.test"}
    bodies = ["{}", json.dumps({"1": [ad("1690000000", "1789900000", 2), ad("1700000000", "1700000001", 1)]}),
              json.dumps({"1": [ad("0", "99999999999999", 1)]}), json.dumps({"1": [ad("1690000000", "1690000001", 1)] * 40, "2": "c"}),
              json.dumps({"1": [ad("1690000000", "1690000001", 1)] * 40})]
    df = spark.createDataFrame(list(enumerate(bodies)), "k int, body string")
    got = {r["k"]: r for r in ads.decode(df).select(
        "k", "found", "creative_count", F.unix_seconds("first_shown").alias("a"), F.unix_seconds("last_shown").alias("b"), "formats", "truncated").collect()}
    assert not got[0]["found"]
    assert (got[1]["creative_count"], got[1]["a"], got[1]["b"], got[1]["formats"]) == (2, 1690000000, 1789900000, ["1", "2"])
    assert got[2]["creative_count"] == 1 and got[2]["a"] is None and got[2]["b"] is None
    assert got[3]["truncated"] and not got[4]["truncated"]


def test_forms(spark):
    html = ("<form id=c1 method=\"post\" action=\"/send#gf_1\"><label for=\"input_1_3\">Email&#39;s</label><input id='input_1_3' name='input_3'>"
            "<label for='d'>Dog's Name</label><input id='d' name='input_4'><textarea name='input_5' placeholder='Your message'></textarea>"
            "<div class='hp-field'><input name='extra'></div></form><form><input name=q></form>"
            "<form method=post class='newsletter'><input type='email' name='e'></form>")
    df = spark.createDataFrame([(1, "https://x.test/contact/", html)], "page_id int, url string, html string")
    got = [(r["form_key"], r["action_url"], r["ok"], r["reason"]) for r in forms.classify(df, "page_id").orderBy("form_index").collect()]
    assert got == [("c1", "https://x.test/send", True, None),
                   ("form-1", "https://x.test/contact/", False, "form is GET, not a submission endpoint"),
                   ("form-2", "https://x.test/contact/", False, "not a contact form (search/newsletter/auth)")]
    fields = {r["name"]: (r["role"], r["is_trap"]) for r in forms.fields_of(forms.forms_of(df)).filter("form_index = 0").collect()}
    assert fields["input_3"] == ("email", False) and fields["input_4"][0] is None
    assert fields["input_5"][0] == "message" and fields["extra"][1]


def test_page_rollup_first_page_wins(spark):
    df = spark.createDataFrame([(1, 1, "<a href='https://calendly.com/a'>x</a> hubspot"), (1, 2, "vagaro.com fbq('init') HubSpot Klaviyo.js")],
                               "site int, seq int, html string")
    r = roll_up(detect(df), "site", "seq").first()
    assert r["booking_present"] and r["marketing_active"] and r["marketing_score"] == 25 + 15 + 8
    assert r["marketing_evidence"].startswith("Meta Ads (fbq('init')); booking: Calendly; martech: Klaviyo, HubSpot")


def test_evidence_enforcement(spark):
    text = "Wyatt leads classes. Charles started everything for Laura and me … Laura, head trainer, is here. Every owner helps out at the big park near the old mill by the river, says no one."
    pages = spark.createDataFrame([(1, text)], "business_id int, text string")
    contacts = [("Charles Doe", "Owner", None, True, "Charles started everything ... Laura, head trainer"),
                ("Wyatt", "Owner", None, True, "Wyatt leads classes"), ("Laura", "head trainer", None, True, None)]
    research = spark.createDataFrame([(1, contacts, "Wyatt leads", "pays per lead")],
                                     f"business_id int, contacts {pool.CONTACTS}, angle_evidence string, angle_caution string") \
        .withColumn("angle_problem", F.lit("p"))
    got = {r["name"]: (r["title"], r["evidence"] is not None, r["is_decision_maker"]) for r in evidence.enforce(research, pages).collect()}
    assert got == {"Charles Doe": (None, True, True), "Wyatt": (None, True, False), "Laura": ("head trainer", False, True)}
    angle = evidence.enforce_angles(research, pages).first()
    assert angle["angle_caution"] is None


def test_pool_rules(spark):
    rows = [(1, 1, "info@a.test", False, "connection closed", True), (1, 2, "other@b.test", False, "5.1.1 no", True),
            (1, 3, "wyatt@a.test", False, "false positive check failed", False), (1, 4, "ghost@a.test", False, "x", False)]
    df = spark.createDataFrame(rows, "business_id int, pos int, email string, verified boolean, verification_error string, is_role boolean")
    pages = spark.createDataFrame([(1, "Mail info@a.test or other@b.test. Ask for Wyatt."), (1, None)], "business_id int, text string")
    usable, dead = pool.split_undeliverable(df)
    assert [r["email"] for r in dead.collect()] == ["other@b.test"]
    kept = {r["email"]: r["kept"] for r in pool.live_pool(usable, pages).collect()}
    assert kept == {"info@a.test": True, "wyatt@a.test": True, "ghost@a.test": False}
    people_ = [("Charles", None, None, True, None), ("Wyatt", None, None, False, None)]
    research = spark.createDataFrame([(1, people_)], f"business_id int, contacts {pool.CONTACTS}")
    assert pool.recipients(pool.ranked(usable, research)).first()["recipient"] == "info@a.test"
    greet = research.select(pool.greeting_name(F.lit("info@a.test"), F.col("contacts")), pool.greeting_name(F.lit("wyatt@a.test"), F.col("contacts"))).first()
    assert tuple(greet) == ("Charles", "Wyatt")


def test_claims(spark):
    now = as_time("2026-01-01 12:00:00")
    state = spark.sql("""SELECT * FROM VALUES (2, 'failed', TIMESTAMP'2026-01-01 11:00:00'), (3, 'claimed', TIMESTAMP'2026-01-01 05:00:00'),
        (4, 'claimed', TIMESTAMP'2026-01-01 11:00:00'), (5, 'imported', TIMESTAMP'2026-01-01 01:00:00') AS t(business_id, status, claimed_at)""")
    wanted = spark.range(1, 6).select(F.col("id").cast("int").alias("business_id"))
    granted, after = candidates.claim(state, wanted, "r", now)
    assert sorted(r[0] for r in granted.collect()) == [1, 2, 3]
    assert after.filter("status = 'claimed'").count() == 4
    assert candidates.claim(state, wanted, "r", now, force=True)[0].count() == 5


def test_fleet_verdicts(spark):
    base = dict(workers=3, down=0, host_state="running", backlog=5, zero_yield_ratio=0.0, recent_timeouts=0, longest_running_sec=10)
    cases = [({"down": 3}, "FLEET_DOWN"), ({"down": 1}, "WORKER_DEGRADED"), ({"host_state": "unreachable"}, "HOST_UNREACHABLE"), ({"backlog": 0}, "IDLE"),
             ({"zero_yield_ratio": 0.5}, "PROXY_DEGRADED"), ({"recent_timeouts": 3}, "PROXY_DEGRADED"), ({"longest_running_sec": 601}, "WEDGED"),
             ({"longest_running_sec": 0}, "STALLED"), ({}, "HEALTHY")]
    for change, expected in cases:
        df = spark.createDataFrame([base | change]).withColumn("last_progress", as_time("2026-01-01 00:00:00"))
        assert df.select(health.verdict(as_time("2026-01-01 01:00:00"))).first()[0] == expected


def test_state_codes(spark):
    df = spark.createDataFrame([("New York", None), ("tx", None), ("Ontario", None), (None, "Park Slope, Brooklyn, NY"), ("", "Nowhere")], "state string, geo_target string") \
        .withColumn("state_source", F.lit(None).cast("string"))
    got = [(r["state"], r["state_source"]) for r in qc.normalise_states(df).collect()]
    assert got == [("NY", "scraped"), ("TX", "scraped"), ("Ontario", "scraped"), ("NY", "inferred_from_geo_target"), (None, None)]


def place(i, **kw):
    return dict(place_id=None, title=f"Biz {i}", category="Dog trainer", categories=["Dog trainer"], review_count=i,
                complete_address={"city": "Town", "state": "CA", "postal_code": None}) | kw


def test_ingest_batch_counts(spark, tmp_path):
    """164 rows, 53 keys, two matches by place, two by domain, 49 new, two log rows."""
    rows = [place(i, place_id=f"p{i}" if i % 2 == 0 else None, web_site=f"https://www.site{i}.test" if i % 2 else None) for i in range(53)]
    batch = [rows[i % 53] for i in range(164)]
    folder = tmp_path / "batch"
    folder.mkdir()
    for n, term in enumerate(("dog trainer in Town", "puppy class in Town")):
        (folder / f"job{n}-{term.replace(' ', '_').lower()}.json").write_text(json.dumps(batch[n::2]))
    (folder / "job9-unknown_search.json").write_text(json.dumps([place(99)]))
    (folder / "job8-dog_trainer_in_town.json").write_text("{not json")
    meta = spark.createDataFrame([(t, "Town", "dog_training", "p1") for t in ("dog trainer in Town", "puppy class in Town")],
                                 "keyword string, geo_target string, service_category string, phase string")
    raw, bad = places.read_places(spark, str(folder))
    assert [(r.file_stem, r.error.split(":")[0]) for r in bad.collect()] == [("job8-dog_trainer_in_town", "JSONDecodeError")]
    tagged, unmatched = places.tag_files(raw, meta)
    assert [r[0] for r in unmatched.collect()] == ["job9-unknown_search"]
    staging = places.staging_rows(tagged)
    assert staging.count() == 164
    known = spark.createDataFrame([(f"b{i}", f"p{i}", None) for i in (0, 2)] + [(f"b{i}", None, f"site{i}.test") for i in (1, 3)], "id string, place_id string, domain string")
    for field in BUSINESS.split(", "):
        name, kind = field.split(" ")
        if name not in known.columns:
            known = known.withColumn(name, F.lit(None).cast(kind))
    out = ingest.run_batch(staging, known, as_time("2026-01-01"), cut=lambda df, n: tables.written(df, str(tmp_path / n)))
    ranks = {r[0]: r[1] for r in out.matched.groupBy("key_rank").count().collect()}
    assert ranks == {1: 2, 2: 2, None: 49}
    assert out.businesses.count() == 53 and out.businesses.filter("id LIKE 'b%' AND length(id) < 5").count() == 4
    log = [tuple(r) for r in out.log.select("results_discovered", "new_businesses", "duplicates").collect()]
    assert len(log) == 2 and sum(r[0] for r in log) == 164
    again = ingest.run_batch(staging, out.businesses, as_time("2026-01-02"))
    assert again.businesses.count() == 53 and again.matched.filter("matched_id IS NULL").count() == 0


def test_reader_answers(spark):
    raws = ['{"code":200,"data":{"content":"' + "word " * 80 + '","httpStatus":404,"url":"https://x.test/","links":{"A":"https://a","":"b"},"usage":{"tokens":7}}}',
            '{"code":422,"name":"E","message":"bad"}', "<html>", '{"code":200,"data":{"content":"tiny"}}']
    df = reader.parse(spark.createDataFrame(list(enumerate(raws)), "k int, raw string"))
    got = [(r["http_status"], r["fetch_error"]) for r in df.orderBy("k").collect()]
    assert got == [(404, None), (422, "bad"), (0, "unparseable response"), (200, "content too short (4 chars)")]
    assert reader.link_rows(df, ["k"]).count() == 1 and reader.token_usage(df).first()["tokens"] == 7


def test_signature_gate(spark):
    body = json.dumps({"id": "1", "event_type": "contact.created", "data": {}})
    sign = lambda b, t="1700000000": hmac.new(b"s3", f"{t}.{b}".encode() if t else b.encode(), hashlib.sha256).hexdigest()
    cases = [(f"t=1700000000,v1=bad,v1={sign(body)}", body, None), ("", body, "no signature header"), ("t=1700000000", body, "no digest in header"),
             ("t=1700000000,v1=00", body, "digest mismatch"), (f"v1={sign(body, None)}", body, None), (f"t=1700000000,v1={sign('{')}", "{", "invalid JSON"),
             (f"t=1800000000,v1={sign(body, '1800000000')}", body, None), (f"t=1600000000,v1={sign(body, '1600000000')}", body, "signature too old"),
             (f"t=1700000000,v1={sign('x' * 300)}", "x" * 300, "payload too large")]
    df = spark.createDataFrame([(i, h, b) for i, (h, b, _) in enumerate(cases)], "i int, header string, body string")
    out = ev.gate(df, "s3", F.timestamp_seconds(F.lit(1700000100)), max_age=1000, max_bytes=200)
    assert [r["reject_reason"] for r in out.orderBy("i").collect()] == [c[2] for c in cases]


def test_events_stream(spark, tmp_path):
    rows = [{"id": i, "event_type": t, "created_at": "2026-01-01T00:00:01.123456789Z", "data": d} for i, t, d in (
        ("a", "contact.created", {}), ("a", "contact.created", {}), (None, "weird.thing", {}), (None, "weird.thing", {}),
        ("c", "campaign.reply_received", {"challenge": "ping"}), ("d", None, {}))]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "e.json").write_text("\n".join(json.dumps(r) for r in rows))
    stream = ev.deduplicate(ev.event_stream(spark, str(folder), EVENT)).filter(~F.coalesce(F.col("data.challenge") != "", F.lit(False)))
    got = ev.run_to_files(stream.select("id", ev.classify(F.col("event_type")).alias("c"), F.date_format("at", "ss.SSSSSS").alias("s")), spark, "t")
    assert sorted((r["id"] or "", r["c"], r["s"]) for r in got.collect()) == [
        ("", "other", "01.123456"), ("", "other", "01.123456"), ("a", "contact", "01.123456"), ("d", "other", "01.123456")]


def test_warmup_tag_is_a_whole_token(spark):
    df = spark.createDataFrame([("Coffee? | warmup 33153D9",), ("x33153D9",), (None,)], "s string")
    assert [r[0] for r in df.select(ev.is_warmup(F.col("s"), F.lit(None).cast("string"))).collect()] == [True, False, False]


def test_ad_dates_up_to_the_latest_told(spark):
    df = spark.createDataFrame([(json.dumps({"1": [{"6": {"1": "4102445000"}, "7": {"1": "99999999999999"}}]}),)], "body string")
    shown = lambda **told: ads.decode(df, **told).select(F.unix_seconds("first_shown"), F.unix_seconds("last_shown")).first()
    assert tuple(shown()) == (None, None) and tuple(shown(latest=9_000_000_000_000)) == (4102445000, None)


def test_ad_responses_of_large_order_numbers(spark, tmp_path):
    from prospectra.catalog.evidence import ad_responses
    spark.createDataFrame([(9_000_001, 7), (9_000_050, 7)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    row = ad_responses(spark, str(tmp_path)).first()
    assert (row["creative_count"], row["first_shown"], row["last_shown"]) == (2, 1600000000 + 9_000_001_000, 1700000000 + 9_000_001_000)


def test_person_candidates_of_short_pages(spark):
    got = people.candidates(page(spark, "Li; Erin Kline, Owner of the place. "))
    assert [(r["name"], r["title"], r["pattern"]) for r in got.collect()] == [("Erin Kline", "Owner", "name_comma_title")]
    assert people.candidates(page(spark, "Li; Erin Kline, Owner of the place. "), shortest=40).count() == 0
