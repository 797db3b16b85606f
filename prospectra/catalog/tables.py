"""Queries over joins, collapses, arg-max forms, coverage grids and distributions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from prospectra.catalog.registry import query
from prospectra.catalog.world import table, world
from prospectra.functions.identity import phone_key
from prospectra.operators import collapse, coverage, diff, match, topk
from prospectra.operators.merge import append_source_once
from prospectra.operators.skew import pack_rows, salted_join
from prospectra.plans import ads


@query("A01 J01", """
    SELECT l_partkey, string_agg(s || l_returnflag, ',' ORDER BY l_suppkey, l_returnflag) AS sources, COUNT(*) AS n
    FROM (SELECT DISTINCT l_partkey, l_suppkey, CAST(l_suppkey AS VARCHAR) AS s, l_returnflag FROM lineitem) GROUP BY l_partkey
""")
def provenance_sets(spark, sf):
    packed = collapse.provenance_arrays(table(spark, sf, "lineitem"), "l_partkey", ["l_suppkey", "l_returnflag"])
    text = F.transform("sources", lambda s: F.concat(s["l_suppkey"].cast("string"), s["l_returnflag"]))
    return packed.select("l_partkey", F.array_join(text, ",").alias("sources"), F.size("sources").cast("long").alias("n"))


@query("A01 W12", """
    SELECT l_returnflag, CAST(floor((rn - 1) / 500) AS BIGINT) AS chunk, COUNT(*) AS n, MIN(k) AS first, MAX(k) AS last, md5(string_agg(k, ',' ORDER BY k)) AS digest
    FROM (SELECT l_returnflag, k, row_number() OVER (PARTITION BY l_returnflag ORDER BY k) AS rn
          FROM (SELECT DISTINCT CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS l_returnflag, l_orderkey AS k FROM lineitem)) GROUP BY 1, 2
""")
def packed_hot_groups(spark, sf):
    """Three very large groups, one without a key, as ordered chunks of 500: every chunk with its ends and a digest."""
    lines = table(spark, sf, "lineitem").withColumn("l_returnflag", F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")))
    packed = pack_rows(collapse.provenance(lines, "l_returnflag", ["l_orderkey"]), ["l_returnflag"], ["l_orderkey"], [], "items", 500)
    keys = F.transform("items", lambda x: x["l_orderkey"])
    return packed.select(
        "l_returnflag", "chunk", F.size("items").cast("long").alias("n"), F.get(keys, F.lit(0)).alias("first"), F.element_at(keys, -1).alias("last"),
        F.md5(F.array_join(keys.cast("array<string>"), ",").cast("binary")).alias("digest"))


@query("A02 W05", """
    SELECT c_mktsegment, c_nationkey, coalesce(min_by(big, c_custkey) FILTER (WHERE big <> ''), '') AS big,
           string_agg(DISTINCT tag, ',' ORDER BY tag) AS categories, COUNT(*) AS source_row_count, MIN(c_custkey) AS min_source_id
    FROM (SELECT *, CASE WHEN c_acctbal > 5000 THEN c_name ELSE '' END AS big, 'b' || CAST(CAST(FLOOR(c_acctbal / 1000) AS BIGINT) AS VARCHAR) AS tag FROM customer)
    GROUP BY 1, 2
""")
def collapsed_listings(spark, sf):
    df = table(spark, sf, "customer").withColumn("big", F.when(F.col("c_acctbal") > 5000, F.col("c_name")).otherwise("")) \
        .withColumn("tag", F.concat(F.lit("b"), F.floor(F.col("c_acctbal") / 1000).cast("string")))
    out = collapse.collapse_listings(
        df.withColumn("c_nationkey", F.col("c_nationkey").cast("string")), ["c_mktsegment", "c_nationkey"], "c_custkey", ["big"], "tag")
    return out.withColumn("categories", F.array_join("categories", ",")).withColumn("c_nationkey", F.col("c_nationkey").cast("int"))


@query("A03 A04 A05", """
    SELECT geo_target, service_category, COUNT(*) AS results, COUNT(DISTINCT business_id) AS businesses,
           COUNT(DISTINCT business_id) FILTER (WHERE status = 'O') AS open_businesses, strftime(MIN(found_at), '%Y-%m-%d') AS first_seen
    FROM hits GROUP BY 1, 2
""", ("hits",))
def search_counts(spark, sf):
    per = world(spark, sf, "hits").groupBy("geo_target", "service_category", "business_id").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("status") == "O").alias("o"), F.min("found_at").alias("s"))
    return per.groupBy("geo_target", "service_category").agg(
        F.sum("n").alias("results"), F.count(F.lit(1)).alias("businesses"), F.count_if("o").alias("open_businesses"),
        F.date_format(F.min("s"), "yyyy-MM-dd").alias("first_seen"))


@query("A05 J08 J14", """
    SELECT term AS query, geo_target, service_category, phase, strftime(MIN(found_at), '%Y-%m-%d') AS searched_at,
           COUNT(DISTINCT business_id) AS results_discovered
    FROM hits WHERE NOT (term = 'dog trainer' AND geo_target LIKE 'Old Town%') GROUP BY 1, 2, 3, 4
""", ("hits",))
def backfilled_log(spark, sf):
    """Search log rebuilt from provenance, minus the searches it already holds."""
    sources = world(spark, sf, "hits").withColumnRenamed("term", "query")
    log = sources.filter((F.col("query") == "dog trainer") & F.col("geo_target").startswith("Old Town")) \
        .select("query", "geo_target", "service_category")
    out = collapse.backfill_log(sources, log, "business_id", "found_at")
    return out.withColumn("searched_at", F.date_format("searched_at", "yyyy-MM-dd"))


@query("W01 W04", """
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) r FROM orders) WHERE r = 1
""")
def largest_order(spark, sf):
    return collapse.representatives(table(spark, sf, "orders"), "o_custkey", "o_totalprice", "o_orderkey") \
        .select("o_custkey", "o_orderkey", "o_totalprice")


@query("W04 J13", """
    SELECT c_custkey, status, price FROM customer LEFT JOIN (
        SELECT o_custkey, o_orderstatus AS status, o_totalprice AS price FROM (
            SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) r FROM orders) WHERE r = 1)
    ON o_custkey = c_custkey
""")
def latest_order(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), "o_orderdate", "o_orderkey")
    newest = topk.latest(o, ["o_custkey"], "o_orderdate", ["status", "price"], "o_orderkey")
    c = table(spark, sf, "customer").select("c_custkey")
    return c.join(newest, c.c_custkey == newest.o_custkey, "left").select("c_custkey", "status", "price")


@query("W10", """
    WITH m AS (SELECT l_orderkey, MAX(l_quantity) AS q FROM lineitem GROUP BY 1)
    SELECT m.l_orderkey, m.q AS l_quantity, CASE WHEN COUNT(*) = 1 THEN MIN(l.l_partkey) END AS l_partkey, COUNT(*) AS tied
    FROM m JOIN lineitem l ON l.l_orderkey = m.l_orderkey AND l.l_quantity = m.q GROUP BY 1, 2
""")
def untied_maximum(spark, sf):
    return topk.best_or_none(table(spark, sf, "lineitem"), ["l_orderkey"], "l_quantity", "l_partkey")


@query("W11 W13", """
    SELECT l_suppkey, l_orderkey, l_linenumber, CAST(r AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_quantity) r FROM lineitem)
    WHERE r <= 3
""")
def top_lines(spark, sf):
    order = [F.col("l_extendedprice").desc(), *[F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")]]
    return topk.first_k(table(spark, sf, "lineitem"), ["l_suppkey"], order, 3).select("l_suppkey", "l_orderkey", "l_linenumber", "rank")


@query("W12 J14", """
    SELECT o_custkey, string_agg(o_orderkey, ',' ORDER BY (o_orderstatus = 'O') DESC, o_orderdate DESC, o_orderkey) AS orders, COUNT(*) AS n
    FROM orders GROUP BY o_custkey
""")
def ordered_arrays(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_custkey", (F.col("o_orderstatus") != "O").alias("late"), (-F.unix_micros(F.col("o_orderdate").cast("timestamp"))).alias("age"), "o_orderkey")
    packed = pack_rows(df, ["o_custkey"], ["late", "age", "o_orderkey"], [], "items")
    return packed.select("o_custkey", F.array_join(F.transform("items", lambda x: x["o_orderkey"].cast("string")), ",").alias("orders"),
                         F.size("items").cast("long").alias("n"))


@query("T01 T02 T06", """
    SELECT id, review_count FROM biz ORDER BY review_count DESC NULLS LAST, id LIMIT 100
""", ("biz",))
def review_budget(spark, sf):
    order = [F.col("review_count").desc_nulls_last(), F.col("id")]
    return topk.budget(world(spark, sf, "biz").select("id", "review_count"), order, 100)


def _match_sql(first_only: bool) -> str:
    keys = "CASE WHEN l.k1 IS NOT NULL THEN {a} WHEN l.k2 IS NOT NULL THEN {b} ELSE {c} END" if first_only else "coalesce({a}, {b}, {c})"
    ids = keys.format(a="m1.id", b="m2.id", c="m3.id")
    if first_only:
        rank = "CASE WHEN l.k1 IS NOT NULL THEN CASE WHEN m1.id IS NOT NULL THEN 1 END WHEN l.k2 IS NOT NULL THEN CASE WHEN m2.id IS NOT NULL THEN 2 END WHEN m3.id IS NOT NULL THEN 3 END"
        n = "CASE WHEN l.k1 IS NOT NULL THEN m1.n WHEN l.k2 IS NOT NULL THEN m2.n ELSE m3.n END"
    else:
        rank = "CASE WHEN m1.id IS NOT NULL THEN 1 WHEN m2.id IS NOT NULL THEN 2 WHEN m3.id IS NOT NULL THEN 3 END"
        n = "CASE WHEN m1.id IS NOT NULL THEN m1.n WHEN m2.id IS NOT NULL THEN m2.n ELSE m3.n END"
    per = "SELECT {k} AS k, min_by(id, (coalesce(-review_count, 1), id)) AS id, COUNT(*) AS n FROM r WHERE {k} IS NOT NULL GROUP BY 1"
    return f"""
        WITH b AS (SELECT *, CASE WHEN id % 4 = 1 THEN 'site' || id % 300 END AS k1,
                          CASE WHEN phone IS NOT NULL THEN right(regexp_replace(phone, '[^0-9]', '', 'g'), 7) END AS k2,
                          name AS k3 FROM biz),
        r AS (SELECT * FROM b), l AS (SELECT *, id AS left_id FROM b),
        m1 AS ({per.format(k='k1')}), m2 AS ({per.format(k='k2')}), m3 AS ({per.format(k='k3')})
        SELECT l.left_id, {ids} AS matched_id, CAST({rank} AS INTEGER) AS key_rank, {n} AS candidates
        FROM l LEFT JOIN m1 ON m1.k = l.k1 LEFT JOIN m2 ON m2.k = l.k2 LEFT JOIN m3 ON m3.k = l.k3"""


def _match_sides(spark, sf):
    b = world(spark, sf, "biz").withColumn("k1", F.when(F.col("id") % 4 == 1, F.concat(F.lit("site"), (F.col("id") % 300).cast("string")))) \
        .withColumn("k2", F.right(phone_key("phone"), F.lit(7))).withColumn("k3", F.col("name"))
    return b.withColumnRenamed("id", "left_id"), b




@query("J02 J18 J24", _match_sql(False), ("biz",))
def waterfall(spark, sf):
    left, right = _match_sides(spark, sf)
    return match.waterfall_match(left, right, "left_id", "id", ["k1", "k2", "k3"], [F.coalesce(-F.col("review_count"), F.lit(1))])


@query("J02", _match_sql(False), ("biz",))
def waterfall_salted(spark, sf):
    """The same match with the commonest key values salted."""
    left, right = _match_sides(spark, sf)
    return match.waterfall_match(left, right, "left_id", "id", ["k1", "k2", "k3"], [F.coalesce(-F.col("review_count"), F.lit(1))], hot_keys=16)


@query("J03", _match_sql(True), ("biz",))
def waterfall_if_null(spark, sf):
    left, right = _match_sides(spark, sf)
    return match.waterfall_match(left, right, "left_id", "id", ["k1", "k2", "k3"], [F.coalesce(-F.col("review_count"), F.lit(1))], "if_null")


@query("J17 J09", """
    SELECT l_orderkey, l_linenumber, l_partkey, p_type FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size > 12
""")
def fan_out_answers(spark, sf):
    """Parts asked about once; small parts give no answer and so no row."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("key"))
    part = table(spark, sf, "part").filter("p_size > 12").select(F.col("p_partkey").alias("key"), "p_type")
    asked = match.probe_keys(lines, "key")
    answers = part.join(asked, "key", "left_semi")
    return match.fan_out(lines, answers, "key").withColumnRenamed("key", "l_partkey")


@query("J17", """
    SELECT l_returnflag, COUNT(*) AS n, SUM(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END) AS total FROM lineitem GROUP BY 1
""")
def salted_hot_join(spark, sf):
    """Three keys hold all rows; salting spreads them."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    rank = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
    lookup = lines.select("l_returnflag").distinct().withColumn("v", rank)
    return salted_join(lines, lookup, ["l_returnflag"], "inner", 8, 16).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))


@query("J22", """
    WITH e AS (SELECT p_name AS name, MIN(p_partkey) AS id FROM part WHERE p_size < 10 GROUP BY 1)
    SELECT p.p_partkey, p.p_name AS name, e.id AS campaign_id, CASE WHEN e.id IS NULL THEN 'create' ELSE 'reuse' END AS action
    FROM part p LEFT JOIN e ON e.name = p.p_name
""")
def reuse_by_name(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("name"), "p_size")
    existing = part.filter(F.col("p_size") < 10).select("name", F.col("p_partkey").alias("campaign_id"))
    return match.find_or_create(part.drop("p_size"), existing, "name", "campaign_id")


@query("J08 J09 J12 P03 P04", """
    SELECT c_custkey FROM customer
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
      AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
""")
def semi_and_anti(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer").select("c_custkey")
    has = o.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    urgent = o.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return c.join(has, "c_custkey", "left_semi").join(urgent, "c_custkey", "left_anti")


@query("J07 P08", """
    SELECT a.p_brand, a.p_type, a.n, coalesce(b.n, 0) AS small FROM
        (SELECT nullif(p_brand, 'Brand#7') AS p_brand, p_type, COUNT(*) AS n FROM part GROUP BY 1, 2) a LEFT JOIN
        (SELECT nullif(p_brand, 'Brand#7') AS p_brand, p_type, COUNT(*) AS n FROM part WHERE p_size < 10 GROUP BY 1, 2) b
        ON a.p_brand IS NOT DISTINCT FROM b.p_brand AND a.p_type = b.p_type
""")
def null_safe_left_join(spark, sf):
    part = table(spark, sf, "part").withColumn("p_brand", F.nullif("p_brand", F.lit("Brand#7")))
    a = part.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    b = part.filter("p_size < 10").groupBy(F.col("p_brand").alias("b"), F.col("p_type").alias("t")).agg(F.count(F.lit(1)).alias("s"))
    return a.join(b, F.col("p_brand").eqNullSafe(F.col("b")) & (F.col("p_type") == F.col("t")), "left") \
        .select("p_brand", "p_type", "n", F.coalesce("s", F.lit(0)).alias("small"))


@query("J19", """
    SELECT p_brand, COUNT(*) AS members, COUNT(DISTINCT p_type) = 1 AND COUNT(p_type) > 1 AS same_type FROM part GROUP BY 1 HAVING COUNT(*) > 1
""")
def group_evidence(spark, sf):
    """Agreement inside a group told from its minimum and maximum; no pair is formed."""
    return table(spark, sf, "part").groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("members"), ((F.min("p_type") == F.max("p_type")) & (F.count("p_type") > 1)).alias("same_type")
    ).filter("members > 1")


TYPES = ["ECONOMY", "STANDARD", "SMALL", "MEDIUM", "LARGE", "PROMO", "UNKNOWN"]
TYPE_LIST = ", ".join(f"'{t}'" for t in TYPES)


@query("J15 A07", f"""
    SELECT b.p_brand, t.t AS p_type, COUNT(p.p_partkey) AS record_count
    FROM (SELECT DISTINCT p_brand FROM part) b CROSS JOIN (SELECT unnest([{TYPE_LIST}]) AS t) t
    LEFT JOIN part p ON p.p_brand = b.p_brand AND p.p_type = t.t GROUP BY 1, 2
""")
def coverage_grid(spark, sf):
    return coverage.grid_counts(table(spark, sf, "part"), "p_brand", "p_type", TYPES)


METROS = [f"NATION_{i}" for i in range(0, 27)]
SERVICES = ["dog_training", "daycare_boarding", "grooming", "pet_insurance"]
_METRO_SQL = f"""
    (SELECT m, s, COUNT(h.hit_id) AS n FROM (SELECT unnest([{", ".join(f"'{m}'" for m in METROS)}]) AS m)
     CROSS JOIN (SELECT unnest([{", ".join(f"'{s}'" for s in SERVICES)}]) AS s)
     LEFT JOIN hits h ON contains(h.geo_target, m) AND h.service_category = s GROUP BY 1, 2)"""


@query("J16 A07 D16", f"SELECT m AS metro, s AS service, n AS record_count FROM {_METRO_SQL}", ("hits",))
def metro_coverage(spark, sf):
    return coverage.metro_counts(spark, world(spark, sf, "hits"), "geo_target", "service_category", METROS, SERVICES)


@query("A06", "SELECT m AS metro, " + ", ".join(
    f"CAST(SUM(n) FILTER (WHERE s = '{s}') AS BIGINT) AS {s}" for s in SERVICES) + f" FROM {_METRO_SQL} GROUP BY 1", ("hits",))
def metro_crosstab(spark, sf):
    counts = coverage.metro_counts(spark, world(spark, sf, "hits"), "geo_target", "service_category", METROS, SERVICES)
    return coverage.metro_crosstab(counts, SERVICES)


@query("D16", f"SELECT m AS metro, s AS service FROM {_METRO_SQL} WHERE n = 0", ("hits",))
def pending_work(spark, sf):
    counts = coverage.metro_counts(spark, world(spark, sf, "hits"), "geo_target", "service_category", METROS, SERVICES)
    return coverage.pending(counts).select("metro", "service")


TERMS = ["dog trainer", "puppy class", "board and train"]


def _plan_sql(cap: str) -> str:
    return f"""
        WITH g AS (SELECT geo_target, n_nationkey AS pos FROM (SELECT DISTINCT geo_target FROM hits) JOIN nation
                   ON geo_target = n_name || ', ST' OR geo_target = 'Old Town, ' || n_name || ', ST'),
        w AS (SELECT geo_target, pos, t || ' in ' || geo_target AS keyword FROM g CROSS JOIN (SELECT unnest({TERMS}) AS t)),
        p AS (SELECT * FROM w WHERE keyword NOT IN (SELECT term || ' in ' || geo_target FROM hits WHERE service_category = 'dog_training' AND geo_target NOT LIKE 'Old%'))
        SELECT keyword, geo_target FROM p {cap}"""


def _plan(spark, sf, cap):
    hits = world(spark, sf, "hits")
    nation = table(spark, sf, "nation")
    name = F.regexp_replace(F.regexp_replace("geo_target", "^Old Town, ", ""), ", ST$", "")
    geos = hits.select("geo_target").distinct().join(nation, name == F.col("n_name")) \
        .select("geo_target", F.col("n_nationkey").alias("position"))
    log = hits.filter(~F.col("geo_target").startswith("Old")).select(
        F.concat_ws(" in ", "term", "geo_target").alias("query"), "service_category")
    return coverage.plan_searches(geos, TERMS, log, "dog_training", "p", cap).select("keyword", "geo_target")


@query("D15 U03", _plan_sql(""), ("hits",))
def planned_searches(spark, sf):
    return _plan(spark, sf, None)


@query("D15 T03", _plan_sql("WHERE geo_target IN (SELECT geo_target FROM p GROUP BY 1 ORDER BY MIN(pos), geo_target LIMIT 7)"), ("hits",))
def planned_searches_capped(spark, sf):
    """Only the first seven places that contribute work, with all their searches."""
    return _plan(spark, sf, 7)


@query("A31 U06", """
    SELECT * FROM (
        SELECT 'ordered' AS stage, COUNT(*) AS eligible, COUNT(*) FILTER (WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')) AS done FROM customer
        UNION ALL SELECT 'urgent', COUNT(*), COUNT(*) FILTER (WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')) FROM customer)
""")
def stage_completion(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    done = {"ordered": o.filter("o_orderstatus = 'F'"), "urgent": o.filter("o_orderpriority = '1-URGENT'")}
    return coverage.stage_completion(table(spark, sf, "customer"), done, "c_custkey").drop("percent")


@query("U06 J10", """
    SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 90)
""")
def requested_not_found(spark, sf):
    e = table(spark, sf, "events")
    return diff.not_found(e, e.filter("event_type = 'purchase' AND value > 90").select("user_id"), "user_id")


@query("A08", """
    SELECT CAST(FLOOR(o_totalprice / 50000) AS BIGINT) AS bucket, COUNT(*) AS n,
           round(100.0::DOUBLE * COUNT(*) / (SELECT COUNT(*) FROM orders), 1) AS percent FROM orders GROUP BY 1
""")
def price_histogram(spark, sf):
    df = table(spark, sf, "orders").select(F.floor(F.col("o_totalprice") / 50000).alias("bucket"))
    return diff.histogram(df, "bucket")


@query("A28", """
    SELECT quantile_cont(review_count, 0.5) AS p50, quantile_cont(review_count, 0.75) AS p75, quantile_cont(review_count, 0.9) AS p90 FROM biz
""", ("biz",))
def review_percentiles(spark, sf):
    return diff.distinct_percentiles(world(spark, sf, "biz"), "review_count", [0.5, 0.75, 0.9])


@query("A28", """
    SELECT round(100.0::DOUBLE * COUNT(*) FILTER (WHERE l_quantity >= 45) / COUNT(*), 1) AS ge_45,
           round(100.0::DOUBLE * COUNT(*) FILTER (WHERE l_quantity >= 25) / COUNT(*), 1) AS ge_25 FROM lineitem
""")
def share_over_cutoff(spark, sf):
    return diff.share_at_or_above(table(spark, sf, "lineitem"), "l_quantity", [45, 25])


@query("A16", """
    SELECT o_orderpriority, COUNT(*) AS total, COUNT(*) FILTER (WHERE o_totalprice >= 400000) AS top,
           round(100.0::DOUBLE * COUNT(*) FILTER (WHERE o_totalprice >= 400000) / COUNT(*), 1) AS pct_top FROM orders GROUP BY 1
""")
def top_share(spark, sf):
    top = F.count_if(F.col("o_totalprice") >= 400000)
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("total"), top.alias("top"), F.round(F.lit(100.0) * top / F.count(F.lit(1)), 1).alias("pct_top"))


@query("A24 A29 U02", """
    SELECT p_brand, string_agg(DISTINCT v, ',' ORDER BY v) AS tags, COUNT(DISTINCT v) AS n
    FROM (SELECT p_brand, p_type AS v FROM part UNION ALL SELECT p_brand, split_part(p_name, ' ', 1) FROM part) GROUP BY 1
""")
def merged_categories(spark, sf):
    long = table(spark, sf, "part").select("p_brand", F.explode(F.array_union(
        F.array("p_type"), F.array(F.split_part("p_name", F.lit(" "), F.lit(1))))).alias("v")).distinct()
    return long.groupBy("p_brand").agg(F.array_sort(F.collect_list("v")).alias("l")).select(
        "p_brand", F.array_join("l", ",").alias("tags"), F.size("l").cast("long").alias("n"))


@query("U07 P10", """
    SELECT id, CASE WHEN id % 3 = 0 THEN 1 WHEN id % 3 = 1 THEN 2 ELSE 1 END AS n, list_contains([primary_category, second_category], 'Dog trainer') AS is_trainer
    FROM biz
""", ("biz",))
def source_added_once(spark, sf):
    i = F.col("id")
    def entry(s: str) -> Column:
        return F.struct(F.lit(s).alias("source"), F.col("name").alias("name"))
    old = F.when(i % 3 == 0, F.array(entry("listing"))).when(i % 3 == 1, F.array(entry("maps"))) \
        .otherwise(F.array().cast("array<struct<source:string,name:string>>"))
    added = append_source_once(old, entry("listing"), F.lit("listing"))
    return world(spark, sf, "biz").select("id", F.size(added).alias("n"),
                                          F.array_contains(F.array("primary_category", "second_category"), "Dog trainer").alias("is_trainer"))


@query("D29 P18 P21 J21", """
    SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN 'BUILDING' END AS segment, CASE WHEN c_nationkey <> 3 THEN '3' END AS nation,
           CASE WHEN c_nationkey <> 3 THEN CAST(c_nationkey AS VARCHAR) END AS old_nation
    FROM customer WHERE (c_mktsegment <> 'BUILDING' OR c_nationkey <> 3) AND lower(c_name) <> 'customer#000000005'
""")
def settings_drift(spark, sf):
    accounts = diff.listed_only(table(spark, sf, "customer"), "c_name", None, ["CUSTOMER#000000005"])
    drift = diff.settings_drift(accounts, {"c_mktsegment": F.lit("BUILDING"), "c_nationkey": F.lit(3)}, ["c_custkey"])
    return drift.select("c_custkey", F.try_element_at("changes", F.lit("c_mktsegment")).alias("segment"),
                        F.try_element_at("changes", F.lit("c_nationkey")).alias("nation"),
                        F.try_element_at("previous", F.lit("c_nationkey")).alias("old_nation"))


@query("ST12", """
    WITH p AS (SELECT user_id AS run_id, event_id AS seq, event_type <> 'click' AS throttled, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
    s AS (SELECT *, n - coalesce(max(CASE WHEN NOT throttled THEN n END) OVER (PARTITION BY run_id ORDER BY n), 0) AS k FROM p)
    SELECT run_id, MIN(CASE WHEN throttled AND k = 12 THEN n END) AS cut_at, MAX(CASE WHEN throttled THEN k ELSE 0 END) AS longest,
           COUNT(*) FILTER (WHERE throttled) AS throttled, COUNT(*) FILTER (WHERE NOT throttled) AS answered FROM s GROUP BY 1
""")
def throttle_cut(spark, sf):
    """Where twelve throttled probes in a row end a run."""
    probes = table(spark, sf, "events").select(F.col("user_id").alias("run_id"), F.col("event_id").alias("seq"),
                                               (F.col("event_type") != "click").alias("throttled"))
    return ads.throttle_cut(probes)


@query("ST12", """
    WITH p AS (SELECT user_id, event_id, event_type <> 'click' AS f, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS position FROM events)
    SELECT user_id, event_id, position, CASE WHEN f THEN position - coalesce(max(CASE WHEN NOT f THEN position END) OVER (PARTITION BY user_id ORDER BY position), 0) ELSE 0 END AS streak FROM p
""")
def running_streaks(spark, sf):
    """Streaks carried over the borders of many small chunks."""
    df = table(spark, sf, "events").select("user_id", "event_id", (F.col("event_type") != "click").alias("f"))
    return topk.running_streak(df, "user_id", "event_id", "f", 200).drop("f")
