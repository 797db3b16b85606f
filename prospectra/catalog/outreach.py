"""Queries over candidates, pools, research evidence, payloads and answer grading."""

from __future__ import annotations

from pyspark.sql import functions as F

from prospectra.catalog.registry import query
from prospectra.catalog.world import table, world
from prospectra.functions.reviews import as_time
from prospectra.plans import candidates as C, evidence as EV, grading as G, payloads as PL, pool as P
from prospectra.session import new_path
from prospectra.sources import tables
from prospectra.sources.buckets import BucketTable
from prospectra.sources.claims import claim as claim_in
from prospectra.schemas import OUTREACH_STATUSES

NOW = "2024-01-20 00:00:00"
PEOPLE = P.CONTACTS


def pool(spark, sf):
    """Address pool of the businesses: their orders' priorities as mailboxes, with check results."""
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "business_id")
    local = F.lower(F.split_part("o_orderpriority", F.lit("-"), F.lit(2)))
    mail = F.concat(F.regexp_replace(local, "[^a-z]", ""), F.lit("@site"), F.col("business_id").cast("string"), F.lit(".test"))
    rows = o.groupBy("business_id", mail.alias("email")).agg(F.min("o_orderkey").alias("pos"), F.max("o_orderdate").alias("at"))
    k = F.col("pos") % 5
    return rows.select(
        "business_id", "email", "pos", F.when(k == 0, True).when(k < 4, False).alias("verified"),
        F.when(k == 1, "5.1.1 unknown").when(k == 2, "timed out").when(k == 3, "false positive check failed").alias("verification_error"),
        (F.col("pos") % 2 == 0).alias("is_role"))


_POOL = """
    p AS (SELECT o_custkey AS business_id, regexp_replace(lower(split_part(o_orderpriority, '-', 2)), '[^a-z]', '', 'g') || '@site' || o_custkey || '.test' AS email,
                 MIN(o_orderkey) AS pos FROM orders GROUP BY 1, 2),
    pool AS (SELECT *, pos % 5 AS k, pos % 2 = 0 AS is_role FROM p)"""


def site_pages(spark, sf):
    """One page per business and order status, naming some of its addresses and people."""
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "business_id")
    first = o.groupBy("business_id", "o_orderstatus").agg(F.min("o_orderkey").alias("k"))
    text = F.concat(
        F.lit("Welcome. Charles ("), F.when(F.col("k") % 2 == 0, "Owner").otherwise("trainer"), F.lit(") and Laura started everything. "),
        F.when(F.col("k") % 3 == 0, F.concat(F.lit("Mail urgent@site"), F.col("business_id").cast("string"), F.lit(".test now. "))).otherwise(""),
        F.when(F.col("k") % 4 == 0, "Ask for Medium or Low."). otherwise("Family business since 1990 …"))
    return first.select("business_id", F.col("o_orderstatus").alias("page_kind"), text.alias("text"))


def research(spark, sf):
    """Research results of the businesses: two people, one angle."""
    c = table(spark, sf, "customer").withColumnRenamed("c_custkey", "business_id")
    i = F.col("business_id")
    people = F.array(
        F.struct(F.lit("Charles").alias("name"), F.lit("Owner").alias("title"), F.lit(None).cast("string").alias("email"),
                 F.lit(True).alias("is_decision_maker"), F.lit("charles (owner) ... no such words").alias("evidence")),
        F.struct(F.lit("Laura").alias("name"), F.when(i % 2 == 0, "Founder").alias("title"), F.concat(F.lit("laura@site"), i.cast("string"), F.lit(".test")).alias("email"),
                 F.lit(True).alias("is_decision_maker"), F.lit("Laura started everything").alias("evidence"))).cast(PEOPLE)
    return c.select(
        "business_id", people.alias("contacts"), F.lit("slow").alias("angle_problem"),
        F.when(i % 3 == 0, "Family business since").otherwise("not printed anywhere").alias("angle_evidence"),
        F.when(i % 2 == 0, "they pay per lead today").otherwise("do not pitch ad spend").alias("angle_caution"),
        (F.col("c_acctbal") / 10000).alias("confidence"), F.lit("hook").alias("personalization_hook"),
        F.array(F.lit("a"), F.lit("b")).alias("pain_signals"))


def drafts(spark, sf):
    """One draft per business, written to two addresses."""
    c = table(spark, sf, "customer").withColumnRenamed("c_custkey", "business_id")
    i = F.col("business_id").cast("string")
    return c.select("business_id", F.array(F.concat(F.lit("URGENT@site"), i, F.lit(".test")), F.lit("outside@gmail.com")).alias("selected"),
                    F.lit("Hello").alias("subject"), F.lit("Body").alias("body"), F.lit("").alias("rationale"))


def outreach_state(spark, sf):
    """Newest event of a user as the state row of the business of the same number."""
    e = table(spark, sf, "events")
    newest = e.groupBy("user_id").agg(F.max_by(F.struct("event_type", "ts"), F.struct("ts", "event_id")).alias("v"))
    kind = F.col("v.event_type")
    status = F.when(kind == "click", "failed").when(kind == "view", "imported").when(kind == "error", "rejected").otherwise("claimed")
    return newest.select(
        F.col("user_id").alias("business_id"), status.alias("status"), F.lit(None).cast("string").alias("reason"), F.lit("r0").alias("run_id"),
        (F.col("v.ts").cast("timestamp") - F.expr("INTERVAL 10 DAYS")).alias("claimed_at"), F.lit(None).cast("timestamp").alias("finished_at"))


_STATE = """
    n AS (SELECT user_id AS business_id, max_by(event_type, (ts, event_id)) AS kind, MAX(ts) - INTERVAL 10 DAY AS claimed_at FROM events GROUP BY 1),
    st AS (SELECT *, CASE kind WHEN 'click' THEN 'failed' WHEN 'view' THEN 'imported' WHEN 'error' THEN 'rejected' ELSE 'claimed' END AS status FROM n)"""


# -- candidates --------------------------------------------------------------------------------

@query("J13 W04", """
    SELECT user_id AS business_email_id, max_by(value > 50, (ts, event_id)) AS verified, max_by(event_type, (ts, event_id)) AS verification_error FROM events GROUP BY 1
""")
def latest_verdicts(spark, sf):
    v = table(spark, sf, "events").select(
        F.col("user_id").alias("business_email_id"), (F.col("value") > 50).alias("verified"), F.col("event_type").alias("error"),
        F.struct("ts", "event_id").alias("verified_at"))
    return C.latest_verdicts(v)


@query("D19 J11 J12 T01 P04", f"""
    WITH {_STATE} SELECT id FROM biz WHERE id % 4 IN (1, 2) AND id IN (SELECT o_custkey FROM orders) AND id IN (SELECT business_id FROM crawl WHERE text <> '')
      AND NOT EXISTS (SELECT 1 FROM st WHERE business_id = id AND status <> 'failed' AND NOT (status = 'claimed' AND claimed_at < TIMESTAMP '{NOW}' - INTERVAL 6 HOUR))
    ORDER BY review_count DESC NULLS LAST, id LIMIT 100
""", ("biz", "crawl"))
def eligible_candidates(spark, sf):
    """The best hundred businesses with an address and page text that no run holds."""
    biz = world(spark, sf, "biz").withColumn("icp_tier", (F.col("id") % 4).cast("string")).withColumn("icp_score", F.col("review_count"))
    return C.eligible(biz, pool(spark, sf), world(spark, sf, "crawl"), ["1", "2"], outreach_state(spark, sf), as_time(NOW), 100).select("id")


@query("W14 U01 D19", """
    SELECT business_id AS id, COUNT(*) AS pages, md5(string_agg('--- ' || page_kind || ': ' || url || ' ---' || chr(10) || trim(text), chr(10) || chr(10) ORDER BY page_kind = 'about', page_kind, page_seq, url)) AS digest
    FROM crawl WHERE business_id IN (SELECT c_custkey FROM customer) AND trim(text) <> '' GROUP BY 1
""", ("crawl",))
def research_context(spark, sf):
    """All page texts of a business joined in order, whole; the second crawler read the about pages."""
    crawl = world(spark, sf, "crawl").select("business_id", "page_kind", F.col("page_seq").alias("fetched_at"), "url", "text")
    blocks = C.context_blocks(world(spark, sf, "biz"), crawl.filter("page_kind <> 'about'"), crawl.filter("page_kind = 'about'"))
    return C.research_context(blocks).select("id", F.col("pages").cast("long").alias("pages"), F.md5(F.col("context").cast("binary")).alias("digest"))


@query("D19 J14", f"""
    WITH {_POOL} SELECT c_custkey AS id, CAST(COUNT(email) AS INTEGER) AS addresses, coalesce(string_agg(email, ',' ORDER BY email), '') AS emails
    FROM customer LEFT JOIN pool ON business_id = c_custkey GROUP BY 1
""")
def nested_addresses(spark, sf):
    chosen = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    held = pool(spark, sf).withColumnRenamed("business_id", "id").withColumn("source", F.lit("crawl")).withColumn("confidence", F.lit(1))
    out = C.nested(chosen, held)
    return out.select("id", F.when(F.col("emails").isNull(), 0).otherwise(F.size("emails")).alias("addresses"),
                      F.coalesce(F.array_join(F.transform("emails", lambda e: e["email"]), ","), F.lit("")).alias("emails"))


@query("D20 J23", f"""
    WITH {_POOL} SELECT c_custkey AS id, coalesce(bool_or(k = 4), FALSE) AS needs_verification,
           c_custkey NOT IN (SELECT business_id FROM crawl WHERE page_kind = 'about' AND text <> '') AS needs_second_crawl
    FROM customer LEFT JOIN pool ON business_id = c_custkey GROUP BY 1
""", ("crawl",))
def gap_flags(spark, sf):
    chosen = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    held = pool(spark, sf).withColumnRenamed("business_id", "id")
    return C.gap_flags(chosen, held, world(spark, sf, "crawl").filter("page_kind = 'about'"))


@query("D25 ST11", f"""
    WITH {_STATE}, g AS (SELECT c_custkey FROM customer LEFT JOIN st ON business_id = c_custkey
        WHERE status IS NULL OR status = 'failed' OR (status = 'claimed' AND claimed_at < TIMESTAMP '{NOW}' - INTERVAL 6 HOUR))
    SELECT coalesce(c_custkey, business_id) AS business_id, CASE WHEN c_custkey IS NOT NULL THEN 'claimed' ELSE status END AS status,
           CASE WHEN c_custkey IS NOT NULL THEN 'r1' ELSE 'r0' END AS run_id FROM g FULL OUTER JOIN st ON business_id = c_custkey
""")
def claims(spark, sf):
    """State after claiming every business: free, failed and stale ones are granted."""
    wanted = table(spark, sf, "customer").select(F.col("c_custkey").alias("business_id"))
    _, after = C.claim(outreach_state(spark, sf), wanted, "r1", as_time(NOW))
    return after.select("business_id", "status", "run_id")


class _Overtaken(BucketTable):
    """A table whose first write is overtaken by another run."""

    other = None

    def _write(self, df, keys, count):
        other, self.other = self.other, None
        if other:
            other()
        return super()._write(df, keys, count)


@query("D25 S09", f"""
    WITH {_STATE}, w AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 > 0 THEN 'b' ELSE 'a' END AS run FROM customer WHERE c_custkey % 3 > 0 OR c_custkey % 2 = 0)
    SELECT id AS business_id, run FROM w LEFT JOIN st ON business_id = id
    WHERE status IS NULL OR status = 'failed' OR (status = 'claimed' AND claimed_at < TIMESTAMP '{NOW}' - INTERVAL 6 HOUR)
""")
def overlapping_claims(spark, sf):
    """Two runs want overlapping businesses; the second commits while the first is writing, and each id is granted once."""
    root = new_path(spark, "claims")
    BucketTable(spark, root).create(outreach_state(spark, sf), ["business_id"], 16)
    ids = table(spark, sf, "customer").select(F.col("c_custkey").alias("business_id"))
    granted = {}
    first = _Overtaken(spark, root)
    first.other = lambda: granted.update(b=claim_in(BucketTable(spark, root), ids.filter("business_id % 3 > 0"), "b", as_time(NOW)))
    granted["a"] = claim_in(first, ids.filter("business_id % 2 = 0"), "a", as_time(NOW))
    return granted["a"].withColumn("run", F.lit("a")).unionByName(granted["b"].withColumn("run", F.lit("b")))


@query("ST11 P06", f"""
    WITH {_STATE} SELECT business_id FROM st WHERE status = 'claimed' AND claimed_at < TIMESTAMP '{NOW}' - INTERVAL 6 HOUR
""")
def expired_claims(spark, sf):
    from prospectra.streaming.health import expired_claims as expired
    return expired(outreach_state(spark, sf), as_time(NOW)).select("business_id")


_OUTCOME = """
    o AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'imported' WHEN 1 THEN 'error' END AS import_status,
                 CASE event_id % 5 WHEN 0 THEN 'rejected' WHEN 1 THEN 'error' WHEN 2 THEN NULL ELSE 'researched' END AS research_status,
                 CASE event_id % 7 WHEN 0 THEN 'failed' WHEN 1 THEN NULL ELSE 'drafted' END AS draft_status, event_type AS error,
                 CASE WHEN event_id % 2 = 0 THEN 'llm_unavailable' END AS rejection_reason, CASE WHEN event_id % 3 = 0 THEN 'llm_unavailable' END AS draft_reason FROM events)"""


def _outcomes(spark, sf):
    i = F.col("event_id")
    return table(spark, sf, "events").select(
        i, i.alias("business_id"), F.when(i % 6 == 0, "imported").when(i % 6 == 1, "error").alias("import_status"),
        F.when(i % 5 == 0, "rejected").when(i % 5 == 1, "error").when(i % 5 > 2, "researched").alias("research_status"),
        F.when(i % 7 == 0, "failed").when(i % 7 > 1, "drafted").alias("draft_status"), F.col("event_type").alias("error"),
        F.when(i % 2 == 0, "llm_unavailable").alias("rejection_reason"), F.when(i % 3 == 0, "llm_unavailable").alias("draft_reason"),
        F.lit(None).cast("string").alias("import_error"), F.lit(None).cast("string").alias("import_reason"))


@query("D26 F43", f"""
    WITH {_OUTCOME} SELECT event_id, CASE WHEN import_status = 'imported' THEN 'imported' WHEN research_status = 'error' OR draft_status = 'error' THEN 'failed'
          WHEN research_status <> 'researched' THEN CASE WHEN rejection_reason = 'llm_unavailable' THEN 'failed' ELSE 'rejected' END
          WHEN draft_status <> 'drafted' THEN CASE WHEN draft_reason = 'llm_unavailable' THEN 'failed' ELSE 'rejected' END ELSE 'failed' END AS status,
        CASE WHEN import_status = 'imported' THEN NULL WHEN research_status = 'error' OR draft_status = 'error' THEN error
          WHEN research_status <> 'researched' THEN coalesce(rejection_reason, research_status)
          WHEN draft_status <> 'drafted' THEN CASE WHEN draft_reason = 'llm_unavailable' THEN 'draft llm_unavailable' ELSE 'draft ' || draft_status END
          WHEN import_status IS NOT NULL THEN 'import failed' ELSE 'did not finish' END AS reason FROM o
""")
def outcome_states(spark, sf):
    df = _outcomes(spark, sf)
    names = ("import_status", "research_status", "draft_status", "error", "rejection_reason", "draft_reason", "import_error", "import_reason")
    out = C.outcome_status({c: F.col(c) for c in names})
    return df.select("event_id", out["status"].alias("status"), out["reason"].alias("reason"))


@query("D26", f"""
    WITH {_STATE}, {_OUTCOME}, j AS (SELECT event_id, CASE WHEN import_status = 'imported' THEN 'imported' WHEN research_status = 'error' OR draft_status = 'error' THEN 'failed'
          WHEN research_status <> 'researched' THEN CASE WHEN rejection_reason = 'llm_unavailable' THEN 'failed' ELSE 'rejected' END
          WHEN draft_status <> 'drafted' THEN CASE WHEN draft_reason = 'llm_unavailable' THEN 'failed' ELSE 'rejected' END ELSE 'failed' END AS status,
        CASE WHEN import_status = 'imported' THEN NULL WHEN research_status = 'error' OR draft_status = 'error' THEN error
          WHEN research_status <> 'researched' THEN coalesce(rejection_reason, research_status)
          WHEN draft_status <> 'drafted' THEN CASE WHEN draft_reason = 'llm_unavailable' THEN 'draft llm_unavailable' ELSE 'draft ' || draft_status END
          WHEN import_status IS NOT NULL THEN 'import failed' ELSE 'did not finish' END AS reason FROM o)
    SELECT business_id, CASE WHEN event_id IS NULL THEN st.status ELSE j.status END AS status, CASE WHEN event_id IS NOT NULL THEN j.reason END AS reason, event_id IS NOT NULL AS finished
    FROM st LEFT JOIN j ON event_id = business_id
""")
def recorded_outcomes(spark, sf):
    """State rows after a run's outcomes; businesses without a row stay without one."""
    after = C.record_outcomes(outreach_state(spark, sf), _outcomes(spark, sf), as_time(NOW))
    return after.select("business_id", "status", "reason", F.col("finished_at").isNotNull().alias("finished"))


@query("D19 J13 W15", f"""
    WITH {_POOL} SELECT business_id AS id, email, k % 2 = 0 AS verified, CASE WHEN k = 1 THEN 'old' END AS verification_error FROM pool WHERE business_id % 3 = 0
""")
def chosen_addresses(spark, sf):
    """Addresses of the chosen businesses with their newest verdict of two."""
    held = pool(spark, sf).drop("verified", "verification_error").withColumn("business_email_id", F.concat_ws(":", "business_id", "email"))
    k = F.col("pos") % 5
    numbered = pool(spark, sf).withColumn("business_email_id", F.concat_ws(":", "business_id", "email"))
    checks = numbered.select("business_email_id", (k % 2 == 0).alias("verified"), F.when(k == 1, "old").alias("error"), F.lit(2).alias("verified_at")) \
        .unionByName(numbered.select("business_email_id", F.lit(False).alias("verified"), F.lit("older").alias("error"), F.lit(1).alias("verified_at")))
    chosen = table(spark, sf, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("id"))
    return C.address_rows(chosen, held, checks).select("id", "email", "verified", "verification_error")


@query("A23", f"""
    WITH {_OUTCOME} SELECT COUNT(*) AS selected, COUNT(*) FILTER (WHERE research_status = 'researched') AS researched, COUNT(*) FILTER (WHERE research_status = 'rejected') AS rejected,
      COUNT(*) FILTER (WHERE draft_status = 'drafted') AS drafted, COUNT(*) FILTER (WHERE import_status = 'imported') AS imported,
      COUNT(*) FILTER (WHERE import_status = 'error') AS import_failed, COUNT(*) FILTER (WHERE research_status = 'error' OR draft_status = 'error') AS errored FROM o
""")
def outcome_tallies(spark, sf):
    return C.tallies(_outcomes(spark, sf))


# -- pools -------------------------------------------------------------------------------------

_PAGES = """
    k AS (SELECT o_custkey AS business_id, o_orderstatus, MIN(o_orderkey) AS k FROM orders GROUP BY 1, 2),
    b AS (SELECT business_id, bool_or(k % 3 = 0) AS shows_urgent, bool_or(k % 4 = 0) AS names, bool_or(k % 2 = 0) AS has_owner, bool_or(k % 4 <> 0) AS family FROM k GROUP BY 1)"""


@query("D21 U05 F23", f"""
    WITH {_POOL.replace('pool AS', 'pool0 AS')}, {_PAGES}, u AS (SELECT *, email LIKE 'urgent@%' AND coalesce(shows_urgent, FALSE) AS on_page FROM pool0 LEFT JOIN b USING (business_id) WHERE k <> 1),
    t AS (SELECT business_id, COUNT(*) FILTER (WHERE on_page) AS shown, COUNT(*) AS n FROM u GROUP BY 1)
    SELECT business_id, email, on_page, shown = 0 OR shown = n OR on_page OR k = 0 OR (NOT is_role AND names AND split_part(email, '@', 1) IN ('medium', 'low')) AS kept FROM u JOIN t USING (business_id)
""")
def live_addresses(spark, sf):
    usable, _ = P.split_undeliverable(pool(spark, sf))
    return P.live_pool(usable, site_pages(spark, sf)).select("business_id", "email", "on_page", "kept")


_RANKED = f"""
    {_POOL}, r AS (SELECT *, CASE k WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END AS c, CASE WHEN is_role THEN 1 ELSE 2 END AS kd FROM pool),
    best AS (SELECT business_id, min_by(email, (c, kd, pos)) AS recipient, MIN((c, kd)) AS lim FROM r GROUP BY 1)"""


@query("W09 D22", f"WITH {_RANKED} SELECT business_id, recipient FROM best")
def recipients(spark, sf):
    return P.recipients(P.ranked(pool(spark, sf), research(spark, sf))).select("business_id", "recipient")


@query("D22", f"""
    WITH {_RANKED}, s AS (SELECT c_custkey AS business_id, 'urgent@site' || c_custkey || '.test' AS e FROM customer),
    j AS (SELECT s.business_id, best.recipient, r.email IS NOT NULL AND (r.c, r.kd) <= best.lim AS ok, r.email IS NOT NULL AS in_pool
          FROM s LEFT JOIN r ON r.business_id = s.business_id AND r.email = s.e LEFT JOIN best ON best.business_id = s.business_id)
    SELECT business_id, CASE WHEN recipient IS NULL THEN 'URGENT@site' || business_id || '.test,outside@gmail.com' WHEN ok THEN 'URGENT@site' || business_id || '.test,outside@gmail.com'
        WHEN NOT in_pool THEN recipient || ',URGENT@site' || business_id || '.test,outside@gmail.com' ELSE recipient || ',outside@gmail.com' END AS selected FROM j
""")
def held_selection(spark, sf):
    held = P.hold_to_recipient(drafts(spark, sf), P.ranked(pool(spark, sf), research(spark, sf)))
    return held.select("business_id", F.array_join("selected", ",").alias("selected"))


# -- research evidence -------------------------------------------------------------------------

@query("D23 F26 F27 F28", f"""
    WITH {_PAGES}, x AS (SELECT c_custkey AS business_id, b.business_id IS NOT NULL AS has_page, coalesce(has_owner, FALSE) AS owner FROM customer LEFT JOIN b ON b.business_id = c_custkey)
    SELECT business_id, 'Charles' AS name, CASE WHEN owner THEN 'Owner' END AS title, CAST(NULL AS VARCHAR) AS evidence, owner AS is_decision_maker FROM x
    UNION ALL SELECT business_id, 'Laura', NULL, CASE WHEN has_page THEN 'Laura started everything' END, has_page FROM x
""")
def supported_people(spark, sf):
    """Titles and quotes the pages do not support are gone; a decider keeps one proof."""
    return EV.enforce(research(spark, sf), site_pages(spark, sf)).select("business_id", "name", "title", "evidence", "is_decision_maker")


@query("D23 F29", f"""
    WITH {_PAGES} SELECT b.business_id, CASE WHEN b.business_id % 2 = 0 THEN NULL ELSE 'do not pitch ad spend' END AS angle_caution
    FROM b WHERE b.business_id % 3 = 0 AND family
""")
def supported_angles(spark, sf):
    return EV.enforce_angles(research(spark, sf), site_pages(spark, sf)).select("business_id", "angle_caution")


@query("D23 F45", f"""
    WITH {_PAGES} SELECT c_custkey AS business_id, CAST(NULL AS VARCHAR) AS email FROM customer
""")
def unsupported_addresses(spark, sf):
    """Addresses tied to a person that are neither live nor printed are removed."""
    people = research(spark, sf).select("business_id", F.element_at("contacts", 2)["email"].alias("email"))
    return EV.enforce_addresses(people, pool(spark, sf), site_pages(spark, sf)).select("business_id", "email")


@query("D24 F37", """
    SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'rejected' WHEN event_id % 13 = 0 THEN 'rejected' WHEN c1 >= 0.7 OR (u AND c2 >= 0.7) THEN 'researched' ELSE 'rejected' END AS status,
           CASE WHEN event_id % 11 = 0 THEN 'no_verified_emails' WHEN event_id % 13 = 0 THEN 'llm_schema_failure' WHEN c1 >= 0.7 THEN NULL WHEN NOT u THEN 'low_confidence_no_escalation_url'
                WHEN c2 >= 0.7 THEN NULL ELSE 'low_confidence_after_two_passes' END AS reason,
           CASE WHEN event_id % 11 = 0 THEN 0 WHEN c1 >= 0.7 OR NOT u THEN 1 ELSE 2 END AS passes,
           CASE WHEN c1 >= 0.8 THEN 'high' WHEN c1 >= 0.6 THEN 'medium' ELSE 'low' END AS label
    FROM (SELECT event_id, CAST(event_id % 10 AS DOUBLE) / 10 AS c1, CAST(event_id % 9 AS DOUBLE) / 9 AS c2, event_id % 3 > 0 AS u FROM events)
""")
def confidence_gate(spark, sf):
    from prospectra.plans.people import confidence_label
    i = F.col("event_id")
    c1, c2 = (i % 10).cast("double") / 10, (i % 9).cast("double") / 9
    out = EV.gate(c1, F.when(i % 3 > 0, "https://x.test"), c2, i % 11 != 0, F.lit(True), F.when(i % 13 == 0, C.failure_reason(F.lit(False))))
    return table(spark, sf, "events").select("event_id", *[out[c].alias(c) for c in ("status", "reason", "passes")], confidence_label(c1).alias("label"))


@query("D23", """
    SELECT id, CASE id % 3 WHEN 0 THEN 'a@x.test' WHEN 1 THEN 'B@x.test' ELSE 'zz@x.test' END AS suggested FROM biz
""", ("biz",))
def suggested_addresses(spark, sf):
    live = F.when(F.col("id") % 3 == 2, F.array().cast("array<string>")).otherwise(F.array(F.lit("a@x.test"), F.lit("b@x.test")))
    said = F.when(F.col("id") % 3 == 1, "B@x.test").otherwise("zz@x.test")
    return world(spark, sf, "biz").select("id", EV.suggested_address(said, live).alias("suggested"))


# -- payloads ----------------------------------------------------------------------------------

def _contacts(spark, sf):
    biz = world(spark, sf, "biz").withColumnRenamed("id", "business_id").withColumn("domain", F.concat(F.lit("site"), F.col("business_id").cast("string"), F.lit(".test"))) \
        .withColumn("icp_tier", F.lit("Tier 1")).withColumn("icp_score", F.lit(90)).withColumn("decision_maker_name", F.lit(None).cast("string")) \
        .withColumn("decision_maker_title", F.lit(None).cast("string"))
    return biz, PL.contact_rows(biz, research(spark, sf), drafts(spark, sf), pool(spark, sf))


@query("D27 F24 F25", f"""
    WITH {_POOL}, d AS (SELECT c_custkey AS business_id, unnest(['URGENT@site' || c_custkey || '.test', 'outside@gmail.com']) AS email FROM customer)
    SELECT business_id, email, TRUE AS is_drafted, CAST(NULL AS VARCHAR) AS skip_reason, 'Charles' AS first_name FROM d
    UNION ALL SELECT business_id, email, FALSE, CASE WHEN k = 1 THEN 'mailbox does not exist' END, 'Charles' FROM pool WHERE email NOT LIKE 'urgent@%'
""")
def contact_payloads(spark, sf):
    _, rows = _contacts(spark, sf)
    return rows.select("business_id", "email", "is_drafted", "skip_reason", "first_name")


@query("D27 P21", f"WITH {_POOL} SELECT business_id, email FROM pool WHERE email LIKE 'urgent@%'")
def drafted_pool(spark, sf):
    return PL.drafted_only(pool(spark, sf), drafts(spark, sf)).select("business_id", "email")


@query("F33 D27", f"""
    WITH {_POOL}, n AS (SELECT c_custkey, 2 + COUNT(email) FILTER (WHERE k <> 1 AND email NOT LIKE 'urgent@%') AS contacts FROM customer LEFT JOIN pool ON business_id = c_custkey GROUP BY 1)
    SELECT contacts, COUNT(*) AS businesses, CAST(MIN(length(CAST(c_custkey AS VARCHAR))) + 32 AS INTEGER) AS shortest FROM n GROUP BY 1
""")
def contact_keys(spark, sf):
    """One idempotency key per business; equal content gives equal keys."""
    _, rows = _contacts(spark, sf)
    keys = PL.idempotency_keys(rows)
    return keys.groupBy("contacts").agg(F.count(F.lit(1)).alias("businesses"), F.min(F.length("idempotency_key")).alias("shortest"))


@query("D28 J22", """
    SELECT c_custkey AS business_id, CASE WHEN c_acctbal < 1000 THEN 'reuse' ELSE 'create' END AS action, 'URGENT@site' || c_custkey || '.test' AS enrolled, 1 AS not_enrolled FROM customer
""")
def campaign_rows(spark, sf):
    biz, rows = _contacts(spark, sf)
    biz = biz.withColumn("name", F.concat(F.lit("b"), F.col("business_id").cast("string")))
    existing = biz.filter("balance < 1000").select(F.col("name").alias("campaign_name"), F.col("business_id").alias("campaign_id"))
    return PL.campaigns(biz, rows, existing).select("business_id", "action", "enrolled", F.col("not_enrolled").cast("int").alias("not_enrolled"))


# -- grading -----------------------------------------------------------------------------------

def _scores(shift: int) -> dict:
    return {c: ((F.col("doc_id") * (i + 1) + shift) % 5 + 1).cast("int") for i, c in enumerate(G.RUBRIC)}


def _score_sql(shift: int) -> str:
    return " + ".join(f"((doc_id * {i + 1} + {shift}) % 5 + 1) * CAST({w} AS DOUBLE)" for i, w in enumerate(G.RUBRIC.values()))


@query("A22 D31", f"""
    SELECT doc_id, round({_score_sql(0)}, 6) AS score, round({_score_sql(0)}, 9) >= 3.5 AND doc_id % 5 + 1 >= 3 AND toxic = 0 AS passed,
           CASE WHEN (quality = 1) > (toxic = 0) THEN TRUE WHEN (quality = 1) < (toxic = 0) THEN FALSE ELSE round({_score_sql(2)}, 6) >= round({_score_sql(0)}, 6) END AS rewrite
    FROM labels
""")
def answer_grades(spark, sf):
    df = table(spark, sf, "labels")
    first, second = F.round(G.weighted_score(_scores(0)), 6), F.round(G.weighted_score(_scores(2)), 6)
    return df.select("doc_id", first.alias("score"), G.passes(_scores(0), F.col("toxic")).alias("passed"),
                     G.prefer_rewrite(F.col("toxic"), first, F.lit(1) - F.col("quality"), second).alias("rewrite"))


@query("F35", """
    SELECT doc_id, doc_id % 4 <> 3 AS usable, CASE WHEN doc_id % 4 <> 3 THEN CAST(greatest(1, least(5, doc_id % 8)) AS INTEGER) END AS correctness, CASE WHEN doc_id % 2 = 0 AND doc_id % 4 <> 3 THEN 1 ELSE 0 END AS unmet
    FROM documents
""")
def evaluator_replies(spark, sf):
    i = F.col("doc_id")
    body = F.concat(F.lit('Sure! {"scores":{"correctness":'), (i % 8).cast("string"), F.lit(',"completeness":3,"relevance":3,"clarity":3,"groundedness":3},"unmet_requirements":['),
                    F.when(i % 2 == 0, '" missing part "').otherwise('""'), F.lit(']} Done.'))
    reply = G.parse_evaluation(F.when(i % 4 == 3, "no json here").otherwise(body))
    return table(spark, sf, "documents").select("doc_id", reply["usable"].alias("usable"), reply["correctness"].alias("correctness"),
                                                F.size(reply["unmet"]).alias("unmet"))


@query("F36 D31", """
    SELECT doc_id, CAST(doc_id % 5 AS INTEGER) AS severe, greatest(CAST(0.1 AS DOUBLE), round(1.0 - CAST(doc_id % 5 AS DOUBLE) * 0.3, 6)) AS confidence, CAST(doc_id % 5 + 1 AS INTEGER) AS lines FROM documents
""")
def critic_replies(spark, sf):
    text = F.concat(F.lit("Intro without bar\nfine | severity: low\n"), F.repeat(F.lit("bad | Severity: high\n"), (F.col("doc_id") % 5).cast("int")))
    out = G.critic(text)
    return table(spark, sf, "documents").select("doc_id", out["severe"].alias("severe"), F.greatest(F.lit(0.1), F.round(out["confidence"], 6)).alias("confidence"),
                                                F.size(out["criticisms"]).alias("lines"))


_METRICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("A17", " UNION ALL ".join(
    f"SELECT '{m}' AS metric, round(CAST(SUM(CAST({m} AS DECIMAL(20,4))) AS DOUBLE) / COUNT({m}), 6) AS mean, MIN({m}) AS min, MAX({m}) AS max, COUNT({m}) AS count FROM lineitem WHERE l_returnflag <> 'N'"
    for m in _METRICS))
def metric_aggregates(spark, sf):
    return G.score_aggregates(table(spark, sf, "lineitem"), _METRICS, F.col("l_returnflag") != "N")


@query("A18 F34", """
    WITH c AS (SELECT event_type || '/m' || user_id % 3 AS model, value < 50 AS ok, event_id % 100 AS p, event_id % 7 AS q FROM events)
    SELECT 'provider' AS level, split_part(model, '/', 1) AS name, COUNT(*) AS calls, COUNT(*) FILTER (WHERE NOT ok) AS failed, CAST(SUM(p) AS BIGINT) AS prompt_tokens,
           CAST(SUM(q) AS BIGINT) AS completion_tokens, CAST(0 AS BIGINT) AS reasoning_tokens, CAST(SUM(p) AS BIGINT) AS cached_tokens FROM c GROUP BY 2
    UNION ALL SELECT 'model', model, COUNT(*), COUNT(*) FILTER (WHERE NOT ok), CAST(SUM(p) AS BIGINT), CAST(SUM(q) AS BIGINT), 0, CAST(SUM(p) AS BIGINT) FROM c GROUP BY 2
""")
def call_usage(spark, sf):
    i = F.col("event_id")
    calls = table(spark, sf, "events").select(
        F.concat("event_type", F.lit("/m"), (F.col("user_id") % 3).cast("string")).alias("model"), (F.col("value") < 50).alias("ok"),
        (i % 100).alias("prompt_tokens"), (i % 7).alias("completion_tokens"), F.lit(None).cast("long").alias("reasoning_tokens"), (i % 100).alias("cached_tokens"))
    return G.usage(calls)


@query("P17", """
    SELECT user_id, event_id, event_type IN ('claimed', 'rejected', 'imported', 'failed') OR value BETWEEN 0 AND 50 AS valid FROM events
""")
def checked_rows(spark, sf):
    """Rows that break a constraint go to a reject table; both sides are returned together."""
    checks = {"status": F.col("event_type").isin(*OUTREACH_STATUSES) | tables.bounded(F.col("value"), 0, 50)}
    good, bad = tables.split_valid(table(spark, sf, "events"), checks)
    return good.select("user_id", "event_id", F.lit(True).alias("valid")).unionByName(bad.select("user_id", "event_id", F.lit(False).alias("valid")))
