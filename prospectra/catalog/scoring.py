"""Queries over scoring, ingest, listings and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from prospectra.catalog.columns import GROWTH_SQL
from prospectra.catalog.registry import query
from prospectra.catalog.world import NOW, TABLES, WORLD, table, world
from prospectra.functions.identity import host, name_key, phone_key
from prospectra.functions.reviews import as_time
from prospectra.operators.diff import histogram
from prospectra.operators.stage import staged
from prospectra.plans import incremental, ingest, listing, qc, raw_enrich, scoring as S
from prospectra.session import new_path
from prospectra.sources import tables
from prospectra.sources.buckets import BucketTable


def _case(key: str, values: dict, default: str = "NULL") -> str:
    parts = " ".join(f"WHEN '{k}' THEN {repr(v) if isinstance(v, str) else v}" for k, v in values.items())
    return f"CASE {key} {parts} ELSE {default} END"


_RANK = {s: i + 1 for i, s in enumerate(S.SERVICE_PRIORITY)}


def scored_sql(cutoffs=S.TIER_CUTOFFS, keyword: str = "NULL", enriched: bool = True, name: str = "scored") -> str:
    """DuckDB text of the scoring of ``biz`` as a CTE body."""
    sig = ", ".join(f"regexp_matches(blob, '{p}') AS h{i}" for i, (p, _, _) in enumerate(S.PREMIUM_SIGNALS))
    points = " + ".join(f"CASE WHEN h{i} THEN {pts} ELSE 0 END" for i, (_, pts, _) in enumerate(S.PREMIUM_SIGNALS))
    echo = " OR ".join(f"(h{i} AND regexp_matches(coalesce(keyword, ''), '{p}'))" for i, (p, _, _) in enumerate(S.PREMIUM_SIGNALS))
    steps = " ".join(f"WHEN rating >= {r} AND review_count >= {c} THEN {p}" for r, c, p in S.REPUTATION_STEPS)
    labels = " || ".join(f"CASE WHEN h{i} THEN '{lb};' ELSE '' END" for i, (_, _, lb) in enumerate(S.PREMIUM_SIGNALS))
    ads = """CASE WHEN ads_confirmed_active THEN CASE WHEN coalesce(ads_creative_count, 0) >= 10 THEN 16 ELSE 12 END
             WHEN coalesce(ads_creative_count, 0) > 0 THEN 4 ELSE 0 END"""
    ad_labels = """CASE WHEN ads_confirmed_active THEN 'confirmed ad spend (last 30d);' || CASE WHEN coalesce(ads_creative_count, 0) >= 10
             THEN 'multiple concurrent creatives;' ELSE '' END WHEN coalesce(ads_creative_count, 0) > 0 THEN 'lapsed ad spend;' ELSE '' END"""
    extra = f"""+ CASE WHEN booking_present THEN 8 ELSE 0 END + CASE WHEN growth_score >= 60 THEN 8 ELSE 0 END + {ads}""" if enriched else ""
    ad_text = f"|| {ad_labels}" if enriched else ""
    return f"""
      {name}_a AS (SELECT *, {keyword} AS keyword, {_case('lower(primary_category)', S.CATEGORY_SERVICE)} AS own, {_case('lower(second_category)', S.CATEGORY_SERVICE)} AS sec,
          lower(primary_category) IN ({", ".join(f"'{d}'" for d in S.DISQUALIFYING)}) AS dq, regexp_matches(primary_category, '{S.PET_PRIMARY}') AS pet,
          lower(concat_ws(chr(10), name, primary_category, primary_category, second_category, description)) AS blob FROM biz),
      {name}_b AS (SELECT *, CASE WHEN dq THEN NULL WHEN own IS NOT NULL THEN own
          WHEN NOT pet AND (sec IS NULL OR sec NOT IN ('veterinary', 'pet_retail', 'pet_insurance')) THEN NULL ELSE sec END AS service, {sig} FROM {name}_a),
      {name}_c AS (SELECT *, CASE WHEN service IS NULL THEN 0 ELSE least(100, greatest(0, {_case('service', S.BASE_SCORE)} + {points}
          + CASE WHEN {echo} THEN 5 ELSE 0 END + CASE {steps} ELSE 0 END + CASE WHEN website IS NOT NULL THEN 4 ELSE 0 END
          + CASE WHEN price_range IS NOT NULL THEN 5 ELSE 0 END {extra}
          - CASE WHEN coalesce(review_count, 0) < 3 AND website IS NULL THEN 20 ELSE 0 END)) END AS score FROM {name}_b),
      {name} AS (SELECT *, CASE WHEN service IS NULL OR score < {cutoffs[2]} THEN 'Tier 4' WHEN score >= {cutoffs[0]} THEN 'Tier 1'
          WHEN score >= {cutoffs[1]} THEN 'Tier 2' ELSE 'Tier 3' END AS tier,
          CASE WHEN service IS NULL THEN 'REJECTED' WHEN website IS NULL AND coalesce(review_count, 0) = 0 THEN 'NEEDS_ENRICHMENT'
               WHEN score < 30 THEN 'LOW_PRIORITY' ELSE 'VALID' END AS qc,
          CASE WHEN service IS NULL THEN 'off-ICP category;' ELSE {labels} {ad_text} END AS labels FROM {name}_c)"""


def with_categories(biz):
    """Businesses with their two categories as the array the scorer reads."""
    return biz.withColumn("categories", F.array("primary_category", "second_category"))


_KEYWORD = "CASE WHEN id % 2 = 0 THEN 'board and train' ELSE 'puppy class' END"


@query("D01 P17 F22", f"WITH {scored_sql(keyword=_KEYWORD)} SELECT id, CAST(score AS INTEGER) AS icp_score, tier AS icp_tier, qc AS qc_status, service AS derived_service, labels AS signals FROM scored", ("biz",))
def icp_scores(spark, sf):
    biz = with_categories(world(spark, sf, "biz")).withColumn(
        "keyword", F.when(F.col("id") % 2 == 0, "board and train").otherwise("puppy class"))
    text = F.concat(F.array_join("signals", ";"), F.when(F.size("signals") > 0, ";").otherwise(""))
    return S.score(biz).select("id", "icp_score", "icp_tier", "qc_status", "derived_service", text.alias("signals"))


def stored_scores(spark, sf):
    """Businesses scored at ingest time: no enrichment, older cutoffs."""
    biz = with_categories(world(spark, sf, "biz"))
    enrichment = ["booking_present", "growth_score", "ads_confirmed_active", "ads_creative_count"]
    old = S.score(biz.drop(*enrichment), (70, 50, 30))
    return old.withColumn("service_category", F.coalesce("derived_service", F.lit("dog_training"))) \
        .join(biz.select("id", *enrichment), "id")


_RESCORE = f"""
    WITH {scored_sql((70, 50, 30), enriched=False, name='old')}, {scored_sql(name='new')},
    d AS (SELECT o.id, o.score AS s0, n.score AS s1, o.tier AS t0, n.tier AS t1, o.qc AS q0, n.qc AS q1,
                 coalesce(o.service, 'dog_training') AS c0, coalesce(n.service, o.service, 'dog_training') AS c1 FROM old o JOIN new n ON n.id = o.id)"""


@query("D02 P18 P20", _RESCORE + """ SELECT id, CAST(s0 AS INTEGER) AS icp_score, CAST(s1 AS INTEGER) AS new_icp_score, t1 AS new_icp_tier, q1 AS new_qc_status, c1 AS new_service_category
    FROM d WHERE s0 <> s1 OR t0 <> t1 OR q0 <> q1 OR c0 <> c1""", ("biz",))
def rescore_changes(spark, sf):
    return S.rescore_changes(stored_scores(spark, sf)).select(
        "id", "icp_score", "new_icp_score", "new_icp_tier", "new_qc_status", "new_service_category")


def _scores(biz):
    """The stored result of scoring, one row per business."""
    return S.score(biz).select("id", "icp_score", "icp_tier", "qc_status")


@query("D02 J23 S09 P18", f"""
    WITH old AS ({WORLD["biz"].format(**{t: t for t in TABLES})}),
    biz AS (SELECT * REPLACE (CASE WHEN id % 11 = 3 THEN 5.0 ELSE rating END AS rating, CASE WHEN id % 17 = 5 THEN 'Museum' ELSE primary_category END AS primary_category) FROM old WHERE id % 13 <> 7
            UNION ALL SELECT * REPLACE (id + 10000000 AS id, 'Luxury Board and Train' AS name) FROM old WHERE id % 19 = 4),
    {scored_sql()}, {scored_sql(name="was").replace("FROM biz)", "FROM old)")}
    SELECT coalesce(n.id, o.id) AS id, CAST(n.score AS INTEGER) AS icp_score, n.tier AS icp_tier, n.qc AS qc_status,
           CASE WHEN o.id IS NULL THEN 'insert' WHEN n.id IS NULL THEN 'delete' WHEN o.id % 11 = 3 AND o.rating <> 5.0 OR o.id % 17 = 5 AND o.primary_category <> 'Museum' THEN 'update' END AS change
    FROM scored n FULL OUTER JOIN was o ON o.id = n.id
""")
def incremental_scores(spark, sf):
    """Scores after businesses were changed, removed and added: only those are scored again, and all equal a full run."""
    biz = with_categories(world(spark, sf, "biz"))
    held, scores = BucketTable(spark, new_path(spark, "biz")), BucketTable(spark, new_path(spark, "scores"))
    held.create(biz, ["id"], 16)
    scores.create(_scores(held.read()), ["id"], 16)
    i = F.col("id")
    changed = biz.withColumn("rating", F.when(i % 11 == 3, 5.0).otherwise(F.col("rating"))) \
        .withColumn("primary_category", F.when(i % 17 == 5, "Museum").otherwise(F.col("primary_category"))).filter((i % 11 == 3) | (i % 17 == 5))
    held.merge(with_categories(changed))
    held.change(biz.filter(i % 13 == 7).select("id"), lambda old: old.filter(i % 13 != 7))
    held.merge(biz.filter(i % 19 == 4).withColumn("id", i + 10_000_000).withColumn("name", F.lit("Luxury Board and Train")))
    incremental.refresh({"biz": incremental.Input(held, 1)}, scores, lambda rows: _scores(rows["biz"]), new_path(spark, "affected"))
    return scores.read().join(incremental.changes(held, 1), "id", "full_outer").select("id", "icp_score", "icp_tier", "qc_status", "change")


@query("D02 A08", _RESCORE + """ SELECT t0 AS icp_tier, COUNT(*) AS n, round(100.0::DOUBLE * COUNT(*) / (SELECT COUNT(*) FROM d), 1) AS percent FROM d GROUP BY 1""", ("biz",))
def tier_histogram(spark, sf):
    return histogram(stored_scores(spark, sf), "icp_tier")


@query("A16 A30", _RESCORE + """ SELECT c0 AS service_category, COUNT(*) AS total, COUNT(*) FILTER (WHERE t0 = 'Tier 1') AS tier1,
    round(100.0::DOUBLE * COUNT(*) FILTER (WHERE t0 = 'Tier 1') / COUNT(*), 1) AS pct_tier1 FROM d GROUP BY 1""", ("biz",))
def tier_one_share(spark, sf):
    first = F.count_if(F.col("icp_tier") == "Tier 1")
    return stored_scores(spark, sf).groupBy("service_category").agg(
        F.count(F.lit(1)).alias("total"), first.alias("tier1"), F.round(F.lit(100.0) * first / F.count(F.lit(1)), 1).alias("pct_tier1"))


@query("D03 F18 F19 J05", f"""{GROWTH_SQL}
    SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 1 THEN 'booking via Vagaro' WHEN 2 THEN 'booking link on own.test' END AS marketing_evidence,
           CASE WHEN n >= 3 THEN score END AS growth_score, CASE WHEN c_custkey % 4 > 0 AND c_custkey % 5 = 0 THEN 'Private lessons, one on one' ELSE 'From the listing' END AS description
    FROM customer LEFT JOIN p ON o_custkey = c_custkey
""")
def raw_enrichment(spark, sf):
    """Booking, growth and description derived from stored listings built of orders, then merged."""
    now = as_time("2000-06-30 00:00:00")
    orders = table(spark, sf, "orders")
    # A stored listing holds all reviews of its business.
    reviews = orders.groupBy(F.col("o_custkey").alias("id")).agg(F.array_sort(F.collect_list(
        F.struct("o_orderkey", F.date_format("o_orderdate", "MMM d, yyyy").alias("published_at")))).alias("user_reviews"))
    raw = world(spark, sf, "biz").join(reviews, "id", "left").select(
        "id", F.when(F.col("id") % 4 > 0, F.col("description")).alias("description"), F.lit("From the listing").alias("raw_description"),
        F.col("booking_present"), F.lit(None).cast("string").alias("marketing_evidence"), F.lit(None).cast("int").alias("growth_score"),
        F.lit(None).cast("string").alias("growth_signal"),
        F.when(F.col("id") % 3 == 1, F.array(F.struct(F.lit("https://www.vagaro.com/x").alias("link"), F.lit("web").alias("source"))))
        .when(F.col("id") % 3 == 2, F.array(F.struct(F.lit("https://own.test/book").alias("link"), F.lit("own.test").alias("source")))).alias("order_online"),
        F.transform("user_reviews", lambda r: F.struct(r["published_at"].alias("published_at"))).alias("user_reviews"))
    derived = raw_enrich.derive(raw, now)
    merged = raw_enrich.apply(raw.drop("order_online", "user_reviews", "raw_description"), derived)
    return merged.select("id", "marketing_evidence", "growth_score", "description")


@query("A09 D03", f"""{GROWTH_SQL}
    SELECT lo || '-' || CASE WHEN lo = 80 THEN 100 ELSE lo + 19 END AS bucket, COUNT(*) AS n
    FROM (SELECT CAST(least(80, floor(score / 20) * 20) AS INTEGER) AS lo FROM p WHERE n >= 3) GROUP BY 1
""")
def growth_score_buckets(spark, sf):
    now = as_time("2000-06-30 00:00:00")
    at = F.col("o_orderdate").cast("timestamp")
    from prospectra.functions.reviews import growth
    s = table(spark, sf, "orders").filter(at <= now).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("a"), F.max(at).alias("b"))
    g = growth(F.col("n"), F.col("a"), F.col("b"), now)
    return raw_enrich.growth_buckets(s.select(g["growth_score"].alias("growth_score")))


# -- ingest ------------------------------------------------------------------------------------

def _facts(spark, sf):
    """What a scrape would say about every business, scored by its own text."""
    biz = with_categories(world(spark, sf, "biz"))
    scored = S.score(biz.drop("booking_present", "growth_score", "ads_confirmed_active", "ads_creative_count"))
    return scored.select(
        F.col("id").alias("business_id"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("place"), F.col("id").cast("string"))).alias("place_id"),
        F.when(F.col("id") % 6 == 1, host("website")).alias("domain"), phone_key("phone").alias("phone_normalized"),
        name_key("name", "city", "state").alias("name_city_state_key"), "name", "website", "phone", "city", "state", "rating",
        "review_count", "primary_category", "categories", "description", "price_range",
        F.coalesce("derived_service", F.lit("dog_training")).alias("service_category"), "icp_score", "icp_tier", "qc_status")


def staging(spark, sf):
    """Orders as staged search hits of the businesses."""
    hits = world(spark, sf, "hits").select("business_id", F.col("term").alias("query"), "geo_target", "phase")
    return hits.join(_facts(spark, sf), "business_id").withColumnRenamed("business_id", "seq")


def master(spark, sf):
    """Businesses known before the batch: the well-rated ones, with an old score and no description."""
    known = _facts(spark, sf).filter(F.col("rating") >= 4.5)
    moment = as_time(NOW)
    return known.select(
        F.concat(F.lit("b"), F.col("business_id").cast("string")).alias("id"), *[c for c in known.columns if c != "business_id"],
        moment.alias("date_discovered"), moment.alias("date_updated")) \
        .withColumn("icp_score", F.lit(1)).withColumn("description", F.lit(None).cast("string"))


def _batch(spark, sf):
    return ingest.run_batch(staging(spark, sf), master(spark, sf), as_time("2026-02-01"),
                            cut=lambda df, label: tables.written(df, new_path(spark, label)), tie="seq")


_STAGED = f"""{scored_sql(enriched=False)},
    facts AS (SELECT id AS business_id, CASE WHEN id % 2 = 0 THEN 'place' || id END AS place_id,
        CASE WHEN id % 6 = 1 THEN 'site' || id % 300 || '.test' END AS domain,
        CASE WHEN phone LIKE '+1%' THEN right(regexp_replace(phone, '[^0-9]', '', 'g'), 10) ELSE regexp_replace(phone, '[^0-9]', '', 'g') END AS phone_normalized,
        regexp_replace(regexp_replace(lower(name), '\\b(llc|inc|corp|co)\\b\\.?', '', 'g'), '[^a-z0-9]+', '', 'g') || '|' || regexp_replace(lower(city), '[^a-z0-9]+', '', 'g') || '|' ||
            regexp_replace(lower(coalesce(state, '')), '[^a-z0-9]+', '', 'g') AS name_key, coalesce(service, 'dog_training') AS service FROM scored),
    stage AS (SELECT f.*, coalesce(place_id, domain, phone_normalized, name_key) AS dedup_key, h.term AS query, h.geo_target, h.phase FROM hits h JOIN facts f USING (business_id))"""


_WHOLE = """
    whole AS (SELECT f.business_id, f.place_id, f.domain, f.phone_normalized, f.name_key, coalesce(f.place_id, f.domain, f.phone_normalized, f.name_key) AS dedup_key, s.name, s.website, s.review_count,
                     CASE WHEN s.description <> '' THEN s.description END AS description, s.score, s.tier, s.qc, f.service, s.rating FROM facts f JOIN scored s ON s.id = f.business_id),
    known AS (SELECT 'b' || business_id AS id, coalesce(-review_count, 1) AS worth, * FROM whole WHERE rating >= 4.5),
    chosen AS (SELECT * FROM whole WHERE business_id IN (SELECT business_id FROM hits) AND dedup_key IS NOT NULL
               QUALIFY row_number() OVER (PARTITION BY dedup_key ORDER BY review_count DESC NULLS LAST, business_id) = 1),
    held AS (SELECT 1 AS rank, place_id AS v, id, worth FROM known WHERE place_id IS NOT NULL UNION ALL SELECT 2, domain, id, worth FROM known WHERE domain IS NOT NULL
             UNION ALL SELECT 3, phone_normalized, id, worth FROM known WHERE phone_normalized IS NOT NULL UNION ALL SELECT 4, name_key, id, worth FROM known WHERE name_key IS NOT NULL),
    first AS (SELECT * FROM held QUALIFY row_number() OVER (PARTITION BY rank, v ORDER BY worth, id) = 1),
    asked AS (SELECT 1 AS rank, place_id AS v, dedup_key FROM chosen UNION ALL SELECT 2, domain, dedup_key FROM chosen UNION ALL SELECT 3, phone_normalized, dedup_key FROM chosen
              UNION ALL SELECT 4, name_key, dedup_key FROM chosen),
    matched AS (SELECT dedup_key, id AS matched_id FROM asked JOIN first USING (rank, v) QUALIFY row_number() OVER (PARTITION BY dedup_key ORDER BY rank) = 1),
    fresh AS (SELECT c.*, matched_id, coalesce(matched_id, 'new ' || c.dedup_key) AS target FROM chosen c LEFT JOIN matched m ON m.dedup_key = c.dedup_key
              QUALIFY row_number() OVER (PARTITION BY coalesce(matched_id, 'new ' || c.dedup_key) ORDER BY review_count DESC NULLS LAST, c.dedup_key) = 1)
"""


@query("D17 P02 A03 A04 J07", f"""
    WITH {_STAGED}, {_WHOLE} SELECT query, geo_target, COUNT(*) AS results_discovered, COUNT(DISTINCT stage.dedup_key || service) FILTER (WHERE matched_id IS NULL AND stage.dedup_key IS NOT NULL) AS new_businesses,
           COUNT(DISTINCT stage.dedup_key || service) FILTER (WHERE matched_id IS NOT NULL) AS duplicates
    FROM stage LEFT JOIN matched ON matched.dedup_key = stage.dedup_key GROUP BY 1, 2
""", ("biz", "hits"))
def ingest_log(spark, sf):
    """Batch log: raw results, new and already known businesses per search."""
    log = _batch(spark, sf).log
    return log.groupBy("query", "geo_target").agg(*[F.sum(c).alias(c) for c in ("results_discovered", "new_businesses", "duplicates")])


_MERGED = f"""
    WITH {_STAGED}, {_WHOLE}
    SELECT coalesce(k.id, 'new ' || f.dedup_key) AS row_key, coalesce(f.name, k.name) AS name, coalesce(f.website, k.website) AS website, coalesce(f.review_count, k.review_count) AS review_count, f.description,
           CAST(CASE WHEN f.target IS NOT NULL THEN f.score ELSE 1 END AS INTEGER) AS icp_score, coalesce(f.tier, k.tier) AS icp_tier, coalesce(f.qc, k.qc) AS qc_status, coalesce(k.service, f.service) AS service_category,
           f.target IS NOT NULL AS touched, k.id IS NULL AS discovered
    FROM known k FULL OUTER JOIN fresh f ON f.target = k.id"""


def _rows(merged):
    """A merged master as the SQL shows it; new rows by their identity."""
    known = F.col("id").rlike("^b[0-9]+$")
    identity = F.coalesce("place_id", "domain", "phone_normalized", "name_city_state_key")
    batch = as_time("2026-02-01")
    return merged.select(
        F.when(known, F.col("id")).otherwise(F.concat(F.lit("new "), identity)).alias("row_key"), "name", "website", "review_count", "description",
        F.col("icp_score").cast("int").alias("icp_score"), "icp_tier", "qc_status", "service_category",
        (F.col("date_updated") == batch).alias("touched"), (F.col("date_discovered") == batch).alias("discovered"))


@query("D17 J02 J04 W01", _MERGED, ("biz", "hits"))
def ingest_batch(spark, sf):
    """Every row of the master table after a batch."""
    return _rows(_batch(spark, sf).businesses)


@query("D17 S09 J04", _MERGED, ("biz", "hits"))
def ingest_into_buckets(spark, sf):
    """The same batch merged into a master in buckets, which stays where it lies."""
    held = BucketTable(spark, new_path(spark, "master"))
    known = master(spark, sf)
    held.create(known, ["id"], 16)
    ingest.store(held, ingest.run_batch(staging(spark, sf), held.read(), as_time("2026-02-01"), tie="seq",
                                        cut=lambda df, label: tables.written(df, new_path(spark, label))), as_time("2026-02-01"))
    return _rows(held.read())


@query("D17 A01", f"""
    WITH {_STAGED} SELECT COUNT(*) AS entries FROM (SELECT DISTINCT dedup_key, query, geo_target, service, phase FROM stage WHERE dedup_key IS NOT NULL)
""", ("biz", "hits"))
def ingest_provenance(spark, sf):
    held = _batch(spark, sf).provenance
    return held.agg(F.count(F.lit(1)).alias("entries"))


# -- directory listings ------------------------------------------------------------------------

TAGS = ("dog-training", "kennels", "pet-grooming", "veterinarians", "pet-stores", "pet-insurance", "restaurants")


def listings(spark, sf):
    """Suppliers and parts as directory rows, one per (business, category) match."""
    from prospectra.operators.collapse import collapse_listings
    hits = world(spark, sf, "hits")
    biz = world(spark, sf, "biz").select("id", "name", "phone", "city", "state")
    tag = F.get(F.array(*[F.lit(t) for t in TAGS]), (F.col("hit_id") % len(TAGS)).cast("int"))
    raw = hits.join(biz, hits.business_id == biz.id).select(
        F.when(F.col("id") % 5 > 0, F.col("name")).otherwise(F.concat(F.lit("New "), "name")).alias("name"), "city", "state",
        F.when(F.col("id") % 5 > 0, F.col("phone")).alias("phone"), F.when(F.col("hit_id") % 2 == 0, "https://x.test").alias("website"),
        tag.alias("category"), "hit_id")
    merged = collapse_listings(raw, ["name", "city", "state"], "hit_id", ["phone", "website"], "category")
    return listing.prepared(merged.withColumn("listing_id", F.col("min_source_id")).withColumn("phone", F.nullif("phone", F.lit(""))))


_LISTED = f"""
    raw AS (SELECT CASE WHEN b.id % 5 > 0 THEN name ELSE 'New ' || name END AS name, city, coalesce(state, '') AS state,
                   CASE WHEN b.id % 5 > 0 THEN phone END AS phone, CASE WHEN hit_id % 2 = 0 THEN 'https://x.test' END AS website,
                   [{", ".join(f"'{t}'" for t in TAGS)}][hit_id % {len(TAGS)} + 1] AS category, hit_id FROM hits h JOIN biz b ON b.id = h.business_id),
    l AS (SELECT name, city, state, MIN(hit_id) AS listing_id, COUNT(*) AS rows_in, min_by(phone, hit_id) FILTER (WHERE phone IS NOT NULL) AS phone,
                 min_by(website, hit_id) FILTER (WHERE website IS NOT NULL) AS website, list_sort(list_distinct(list(category))) AS cats FROM raw GROUP BY 1, 2, 3),
    p AS (SELECT *, regexp_replace(phone, '[^0-9]', '', 'g') AS digits,
                 CASE WHEN list_contains(cats, 'dog-training') THEN 'dog_training' WHEN list_contains(cats, 'kennels') THEN 'daycare_boarding'
                      WHEN list_contains(cats, 'pet-insurance') THEN 'pet_insurance' WHEN list_contains(cats, 'veterinarians') THEN 'veterinary'
                      WHEN list_contains(cats, 'pet-grooming') THEN 'grooming' WHEN list_contains(cats, 'pet-stores') THEN 'pet_retail' END AS service FROM l)"""


@query("D18 P15 A02", f"""WITH {_LISTED} SELECT listing_id, rows_in AS source_row_count, service AS service_category, website IS NOT NULL AS has_site,
    CASE WHEN length(digits) = 11 THEN substring(digits, 2) ELSE digits END AS phone_normalized FROM p""", ("biz", "hits"))
def directory_listings(spark, sf):
    return listings(spark, sf).select("listing_id", "source_row_count", "service_category", (F.col("website") != "").alias("has_site"), "phone_normalized")


def _listing_merge(spark, sf):
    found = tables.written(listings(spark, sf), new_path(spark, "listings"))
    known = with_categories(world(spark, sf, "biz")).withColumn("phone_normalized", phone_key("phone")) \
        .withColumn("name_city_state_key", name_key("name", "city", "state")).withColumn("date_discovered", as_time(NOW)) \
        .withColumn("icp_score", F.lit(60)).withColumn("marketing_evidence", F.when(F.col("id") % 3 == 0, "Meta Ads (x)")) \
        .withColumn("directory_listed", F.lit(False)).select(
            "id", "name", "categories", "phone_normalized", "name_city_state_key", "date_discovered", "icp_score", "marketing_evidence", "directory_listed")
    return found, known, listing.match(found, known)


_NEW_POINTS = f"least(100, greatest(0, {_case('service', S.BASE_SCORE)} + 7 + CASE WHEN website IS NOT NULL THEN 4 ELSE -20 END))"


@query("D18 J03 P16", f"""
    WITH {_LISTED}, n AS (SELECT *, CAST({_NEW_POINTS} AS INTEGER) AS pts FROM p WHERE name LIKE 'New %' AND service IS NOT NULL)
    SELECT service AS service_category, pts AS icp_score, CASE WHEN pts >= 70 THEN 'Tier 1' WHEN pts >= 50 THEN 'Tier 2' WHEN pts >= 30 THEN 'Tier 3' ELSE 'Tier 4' END AS icp_tier,
           CASE WHEN website IS NULL THEN 'NEEDS_ENRICHMENT' ELSE 'VALID' END AS qc_status,
           CASE WHEN list_contains(cats, 'dog-training') THEN 'dog trainer' WHEN list_contains(cats, 'kennels') THEN 'pet boarding service' WHEN list_contains(cats, 'pet-grooming') THEN 'pet groomer'
                WHEN list_contains(cats, 'veterinarians') THEN 'veterinarian' WHEN list_contains(cats, 'pet-stores') THEN 'pet store' ELSE 'pet insurance' END AS primary_category, COUNT(*) AS n
    FROM n GROUP BY ALL
""", ("biz", "hits"))
def directory_new_businesses(spark, sf):
    found, _, matches = _listing_merge(spark, sf)
    fresh = listing.new_businesses(found, matches)
    return fresh.groupBy("service_category", "icp_score", "icp_tier", "qc_status", "primary_category").agg(F.count(F.lit(1)).alias("n"))


def _key_sql(name: str) -> str:
    squeezed = lambda c: f"regexp_replace(lower({c}), '[^a-z0-9]+', '', 'g')"
    bare = f"regexp_replace(lower({name}), '\\b(llc|inc|corp|co)\\b\\.?', '', 'g')"
    return f"{squeezed(bare)} || '|' || {squeezed('city')} || '|' || {squeezed("coalesce(state, '')")}"


@query("D18 U07 A24", f"""
    WITH {_LISTED}, b AS (SELECT *, right(regexp_replace(phone, '[^0-9]', '', 'g'), 10) AS digits, {_key_sql('name')} AS k FROM biz),
    m1 AS (SELECT digits, MIN(id) AS id FROM b WHERE digits IS NOT NULL GROUP BY 1), m2 AS (SELECT k, MIN(id) AS id FROM b GROUP BY 1),
    m AS (SELECT CASE WHEN p.digits IS NOT NULL THEN m1.id ELSE m2.id END AS id, unnest(cats) AS tag
          FROM (SELECT *, {_key_sql('name')} AS k FROM p) p LEFT JOIN m1 ON m1.digits = right(p.digits, 10) LEFT JOIN m2 ON m2.k = p.k),
    t AS (SELECT id, tag FROM m WHERE id IS NOT NULL UNION SELECT id, unnest([primary_category, second_category]) FROM biz WHERE id IN (SELECT id FROM m))
    SELECT id, 67 AS icp_score, 'Tier 2' AS icp_tier, CASE WHEN id % 3 = 0 THEN 'Meta Ads (x); ' ELSE '' END || 'yellow_pages_paid_listing' AS marketing_evidence,
           string_agg(tag, ',' ORDER BY tag) AS categories, 'maps,yellow_pages' AS sources FROM t GROUP BY id
""", ("biz", "hits"))
def directory_updates(spark, sf):
    """Businesses changed by the listings; some had the listing among their sources before."""
    found, known, matches = _listing_merge(spark, sf)
    changed = listing.updated_businesses(found, matches, known)
    sources = known.select("id", F.lit("maps").alias("source")).unionAll(known.filter("id % 10 = 0").select("id", F.lit(listing.LISTING_SOURCE)))
    held = listing.updated_sources(matches, sources).groupBy("id").agg(F.array_join(F.array_sort(F.collect_list("source")), ",").alias("sources"))
    return changed.join(held, "id").select(
        "id", "icp_score", "icp_tier", "marketing_evidence", F.array_join("categories", ",").alias("categories"), "sources")


# -- quality checks ----------------------------------------------------------------------------

_CODES = ", ".join(f"'{k}': '{v}'" for k, v in qc.STATE_CODES.items())


@query("P13 P14", f"""
    WITH s AS (SELECT id, state, CASE WHEN id % 2 = 0 THEN 'Oak Park, TX' ELSE 'Ontario' END AS geo FROM biz),
    c AS (SELECT *, CASE WHEN state IN ('CA', 'TX') THEN state WHEN state = 'New York' THEN 'NY' WHEN state = 'california' THEN 'CA' END AS code,
                 CASE WHEN geo LIKE '%, TX' THEN 'TX' END AS inferred FROM s)
    SELECT id, CASE WHEN coalesce(state, '') <> '' THEN coalesce(code, state) ELSE inferred END AS state,
           CASE WHEN coalesce(state, '') <> '' THEN 'scraped' WHEN inferred IS NOT NULL THEN 'inferred_from_geo_target' END AS state_source,
           CASE WHEN coalesce(state, '') <> '' THEN CASE WHEN code IS NULL THEN 'unresolved' WHEN code = state THEN 'already_ok' ELSE 'normalized' END
                WHEN inferred IS NOT NULL THEN 'inferred' ELSE 'unresolved' END AS state_outcome FROM c
""", ("biz",))
def normalised_states(spark, sf):
    biz = world(spark, sf, "biz").select("id", "state", F.when(F.col("id") % 2 == 0, "Oak Park, TX").otherwise("Ontario").alias("geo_target"),
                                         F.lit(None).cast("string").alias("state_source"))
    return qc.normalise_states(biz).drop("geo_target")


@query("D14 J19", """
    SELECT k AS name_city_state_key, COUNT(*) AS members,
           (COUNT(DISTINCT source) = 1 AND COUNT(source) > 1) OR (COUNT(DISTINCT lang) = 1 AND COUNT(lang) > 1) AS corroborated,
           CASE WHEN COUNT(DISTINCT source) = 1 THEN 'same name+city, shared domain' WHEN COUNT(DISTINCT lang) = 1 AND COUNT(lang) > 1 THEN 'same name+city, shared phone'
                ELSE 'same name+city, no shared domain or phone' END AS reason, MIN(doc_id) AS first_id, MAX(doc_id) AS last_id
    FROM (SELECT doc_id, source, lang, md5(lower(regexp_replace(text, '[^A-Za-z0-9]+', '', 'g'))) AS k FROM documents) GROUP BY 1 HAVING COUNT(*) > 1
""")
def duplicate_flags(spark, sf):
    """Documents with the same squeezed text as one name key, corroborated by source or language."""
    return qc.duplicate_candidates(_duplicate_input(spark, sf)).select(
        "name_city_state_key", "members", "corroborated", "reason", "first_id", "last_id")


def _duplicate_input(spark, sf):
    key = F.md5(F.lower(F.regexp_replace("text", "[^A-Za-z0-9]+", "")).cast("binary"))
    keyed = staged(table(spark, sf, "documents").select("doc_id", "source", "lang", "text"), {"name_city_state_key": key}, ("text",))
    return keyed.withColumnsRenamed({"doc_id": "id", "source": "domain", "lang": "phone_normalized"})


@query("D14 S10", """
    SELECT id, name_city_state_key FROM (SELECT doc_id AS id, md5(lower(regexp_replace(text, '[^A-Za-z0-9]+', '', 'g'))) AS name_city_state_key FROM documents)
    QUALIFY COUNT(*) OVER (PARTITION BY name_city_state_key) > 1
""")
def duplicate_members(spark, sf):
    # Keys and flags are written once: the texts are read for neither the queue nor its members again.
    rows = tables.written(_duplicate_input(spark, sf), new_path(spark, "name-keys"))
    flags = tables.written(qc.duplicate_candidates(rows), new_path(spark, "duplicate-flags"))
    queue = qc.open_reviews(flags, flags)
    return qc.duplicate_members(rows, queue).select("id", "name_city_state_key")
