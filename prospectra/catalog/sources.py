"""Queries over sources and sinks: reading, typing, writing and reading back."""

from __future__ import annotations

from pyspark.sql import functions as F

from prospectra.catalog.registry import query
from prospectra.catalog.scoring import scored_sql
from prospectra.catalog.world import table, world
from prospectra.functions import text as T
from prospectra.operators import coverage
from prospectra.operators.merge import insert_absent, last_per_key, merge_upsert, restore_values
from prospectra.plans import page_signals
from prospectra.schemas import EVENT
from prospectra.session import new_path
from prospectra.sources import places, reader, tables
from prospectra.sources.array_files import ArrayFiles
from prospectra.streaming import events as ev


def _place_folder(spark, sf):
    """Businesses as JSON array files of up to a hundred, named by job and search; every seventh file is cut off."""
    folder = new_path(spark, "places")
    biz = world(spark, sf, "biz")
    stem = F.concat(F.lit("job"), F.floor(F.col("id") / 400).cast("string"), F.lit("-term_"), (F.col("id") % 4).cast("string"), F.lit("_in_town"))
    place = F.struct(
        F.col("id").cast("string").alias("place_id"), F.col("name").alias("title"), F.col("website").alias("web_site"), "phone",
        F.struct("city", "state").alias("complete_address"), F.col("rating").alias("review_rating"), F.col("review_count").cast("int").alias("review_count"),
        F.col("primary_category").alias("category"), F.array("primary_category", "second_category").alias("categories"), "description", "price_range")
    files = biz.groupBy(stem.alias("stem"), F.floor(F.col("id") / 400).alias("job")).agg(F.array_sort(F.collect_list(place)).alias("places"))
    whole = F.to_json("places")
    text = F.when(F.col("job") % 7 == 3, F.left(whole, F.length(whole) - 9)).otherwise(whole)
    files.select("stem", text.alias("value")).write.partitionBy("stem").text(folder)
    found, bad = places.read_places(spark, folder, ".txt")
    own = F.regexp_extract("file", "stem=([^/]+)/", 1)
    return found.withColumn("file_stem", own), bad.withColumn("file_stem", own)


def _searches(spark):
    return spark.createDataFrame([(f"term {i} in town", "town", "dog_training", "p1") for i in range(3)],
                                 "keyword string, geo_target string, service_category string, phase string")


_READ = "floor(id / 400) % 7 <> 3"


@query("S01 S02 P01 F05 F06 F22", f"""
    WITH {scored_sql(enriched=False)} SELECT id, name, 'term ' || id % 4 || ' in town' AS query, city, primary_category, CAST(score AS INTEGER) AS icp_score, tier AS icp_tier, qc AS qc_status,
           coalesce(service, 'dog_training') AS service_category, CASE WHEN phone LIKE '+1%' THEN right(regexp_replace(phone, '[^0-9]', '', 'g'), 10) ELSE regexp_replace(phone, '[^0-9]', '', 'g') END AS phone_normalized
    FROM scored WHERE id % 4 < 3 AND {_READ}
""", ("biz",))
def place_files(spark, sf):
    """Staging rows of place files that a search claims, by way of the file source."""
    found, _ = _place_folder(spark, sf)
    tagged, _ = places.tag_files(found, _searches(spark))
    return places.staging_rows(tagged).select(
        F.col("place_id").cast("long").alias("id"), "name", "query", "city", "primary_category", "icp_score", "icp_tier", "qc_status", "service_category", "phone_normalized")


@query("S01 S02", f"""
    SELECT DISTINCT 'job' || CAST(floor(id / 400) AS BIGINT) || '-term_' || id % 4 || '_in_town' AS file_stem, CASE WHEN {_READ} THEN 'no search' ELSE 'JSONDecodeError' END AS why
    FROM biz WHERE NOT ({_READ}) OR id % 4 = 3
""", ("biz",))
def unread_place_files(spark, sf):
    """Every file that is cut off, with its error, and every file that no search claims."""
    found, bad = _place_folder(spark, sf)
    _, unclaimed = places.tag_files(found, _searches(spark))
    return bad.select("file_stem", F.split_part("error", F.lit(":"), F.lit(1)).alias("why")).unionByName(unclaimed.select("file_stem", F.lit("no search").alias("why")))


@query("S19 ST01 S01", """
    SELECT event_type, COUNT(*) AS n, MIN(event_id) AS first, MAX(event_id) AS last FROM events WHERE floor(event_id / 500) % 5 <> 2 GROUP BY 1
""")
def stream_array_files(spark, sf):
    """Events as array files that arrive in two lots, read as a stream; cut-off files give error rows only."""
    folder, out, mark = (new_path(spark, x) for x in ("event-files", "event-rows", "event-progress"))
    spark.dataSource.register(ArrayFiles)
    lot = F.floor(F.col("event_id") / 500)
    rows = table(spark, sf, "events").select(lot.alias("lot"), F.struct("event_id", "event_type").alias("e"))
    whole = F.to_json(F.collect_list("e"))
    files = rows.groupBy("lot").agg(whole.alias("value"))
    files = files.select("lot", F.when(F.col("lot") % 5 == 2, F.left("value", F.length("value") - 3)).otherwise(F.col("value")).alias("value"))
    for part in (files.filter("lot % 2 = 0"), files.filter("lot % 2 = 1")):
        part.write.mode("append").partitionBy("lot").text(folder)
        stream = spark.readStream.format("array_files").option("suffix", ".txt").load(folder)
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    read = spark.read.schema(stream.schema).parquet(out).filter("error IS NULL").select(F.from_json("element", "event_id long, event_type string").alias("e")).select("e.*")
    return read.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"), F.max("event_id").alias("last"))


@query("S03 D15 T03", """
    SELECT 'svc' || r_regionkey || ' in ' || g.geo AS keyword, g.geo AS geo_target, n_nationkey AS metro_pos, g.pos AS geo_pos
    FROM nation JOIN region ON n_regionkey = r_regionkey, LATERAL (SELECT unnest([n_name, 'Old ' || n_name, 'New ' || n_name]) AS geo, unnest([0, 1, 2]) AS pos) g
    WHERE r_regionkey = 1
""")
def lookup_plan(spark, sf):
    """Searches planned from the two nested lookup files, built of nations and regions."""
    metros_path, terms_path = new_path(spark, "metros"), new_path(spark, "terms")
    nations = table(spark, sf, "nation").select(F.struct(
        F.col("n_nationkey").alias("pos"), F.col("n_name").alias("metro"), F.col("n_name").alias("core_city"),
        F.array(F.concat(F.lit("Old "), "n_name"), F.concat(F.lit("New "), "n_name")).alias("suburbs")).alias("m"))
    nations.agg(F.transform(F.array_sort(F.collect_list("m")), lambda m: F.struct(m["metro"].alias("metro"), m["core_city"].alias("core_city"), m["suburbs"].alias("suburbs"))).alias("metros")) \
        .write.json(metros_path)
    terms = table(spark, sf, "region").agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat(F.lit("service"), "r_regionkey").alias("k"), F.array(F.concat(F.lit("svc"), "r_regionkey")).alias("v")))).alias("t"))
    terms.select(F.to_json("t").alias("value")).write.text(terms_path)
    metros, held = places.read_lookup(spark, metros_path, terms_path)
    region = table(spark, sf, "nation").filter("n_regionkey = 1").select(F.col("n_name").alias("metro"))
    plan = coverage.plan_searches(
        coverage.geo_plan(metros.join(region, "metro", "left_semi")), [r.term for r in held.filter("service = 'service1'").collect()],
        spark.createDataFrame([], "query string, service_category string"), "service1", "p1")
    return plan.select("keyword", "geo_target", F.col("position.metro_pos").cast("long").alias("metro_pos"), F.col("position.geo_pos").alias("geo_pos"))


@query("S13 T06", """
    SELECT id, name, review_count FROM biz
""", ("biz",))
def report_round_trip(spark, sf):
    """A tab-separated report with header, read back."""
    path = new_path(spark, "report")
    tables.write_report(world(spark, sf, "biz").select("id", "name", "review_count").orderBy(F.desc_nulls_last("review_count"), "id"), path)
    return spark.read.option("sep", "\t").option("header", True).schema("id long, name string, review_count long").csv(path)


@query("S15 F29 D30", """
    SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN '[First Name]' WHEN 1 THEN '[Business Name]' END AS placeholder, c_custkey % 5 > 1 AS clean FROM customer
""")
def draft_files(spark, sf):
    """Drafts from JSON files, arrays and single objects, and the placeholder each still holds."""
    path = new_path(spark, "drafts")
    i = F.col("c_custkey")
    body = F.concat(F.lit("Hello "), F.when(i % 5 == 0, "[First Name]").when(i % 5 == 1, "[Business Name]").otherwise("Erin"), F.lit(", we saw your kennel."))
    draft = F.struct(i.alias("id"), body.alias("body"))
    rows = table(spark, sf, "customer").groupBy(F.floor(i / 50).alias("file")).agg(F.collect_list(draft).alias("all"))
    single = F.size("all") == 1
    rows.select("file", F.when(single, F.to_json(F.get("all", F.lit(0)))).otherwise(F.to_json("all")).alias("value")).write.partitionBy("file").text(path)
    held = tables.read_drafts(spark, path, "id long, body string")
    found = T.find_placeholder(F.col("body"))
    return held.select("id", found.alias("placeholder"), found.isNull().alias("clean"))


@query("S04 S05 S13", """
    SELECT id, name, website, review_count, rating, [primary_category, second_category][2] AS second FROM biz
""", ("biz",))
def csv_round_trip(spark, sf):
    path = new_path(spark, "staging")
    biz = world(spark, sf, "biz")
    places.write_staging_csv(biz.select(
        "id", "name", "website", "review_count", "rating",
        F.array("primary_category", "second_category").alias("categories"), F.lit("").alias("about")), path)
    back = places.read_staging_csv(
        spark, path, "id long, name string, website string, review_count long, rating double, categories string")
    return back.select("id", "name", "website", "review_count", "rating", F.col("categories")[1].alias("second"))


@query("S06 S16", """
    SELECT DISTINCT term || ' in ' || geo_target AS line FROM hits
""", ("hits",))
def search_list_file(spark, sf):
    text, meta = new_path(spark, "searches"), new_path(spark, "searches-meta")
    plan = world(spark, sf, "hits").select(
        F.concat_ws(" in ", "term", "geo_target").alias("keyword"), "geo_target", "service_category", "phase")
    places.write_searches(plan.dropDuplicates(["keyword"]), text, meta)
    return places.read_lines(spark, text)


@query("S07 S08", """
    SELECT o_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS quantity, COUNT(*) AS n
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL
""")
def rows_from_payload(spark, sf):
    items = table(spark, sf, "lineitem")
    count = items.count()  # from the files' footers
    lines = items.select("l_orderkey", F.to_json(F.array(F.struct(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.col("l_quantity").cast("long").alias("quantity")))).alias("payload"))
    orders = table(spark, sf, "orders").select("o_orderkey")
    rows = tables.rows_from_json(lines, "payload", "o_orderkey:bigint,l_linenumber:int,quantity:bigint")
    # Sort, join and groups of a task take memory by its rows, so tasks grow in number instead.
    rows, orders = tables.dealt(rows, count, "o_orderkey"), tables.dealt(orders, count, "o_orderkey")
    return rows.join(orders, "o_orderkey").groupBy("o_orderkey", "l_linenumber", "quantity").agg(F.count(F.lit(1)).alias("n"))


OLD = "o_orderdate < TIMESTAMP '2000-01-01'"


def versions(spark, sf):
    """Orders as an old state and a batch of changes that overlap by one year."""
    o = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "id").select(
        "id", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
        F.when(F.col("id") % 3 == 0, F.col("o_orderpriority")).alias("priority"), F.year("o_orderdate").alias("y"))
    target = o.filter(F.col("y") < 2000).drop("y").withColumn("kept", F.lit("target"))
    source = o.filter(F.col("y") >= 1999).drop("y") \
        .withColumn("status", F.when(F.col("id") % 2 == 0, F.lower("status"))) \
        .withColumn("priority", F.lit("new")).withColumn("price", F.col("price") + 1)
    return target, source


_MERGE_SQL = """
    WITH o AS (SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price,
                      CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS priority, year(o_orderdate) AS y FROM orders),
    s AS (SELECT id, CASE WHEN id % 2 = 0 THEN lower(status) END AS status, price + 1 AS price, 'new' AS priority FROM o WHERE y >= 1999),
    t AS (SELECT * FROM o WHERE y < 2000)
    SELECT coalesce(t.id, s.id) AS id, coalesce(s.status, t.status) AS status,
           CASE WHEN s.id IS NOT NULL THEN s.price ELSE t.price END AS price,
           coalesce(t.priority, s.priority) AS priority, CASE WHEN t.id IS NOT NULL THEN 'target' END AS kept
    FROM t FULL OUTER JOIN s ON t.id = s.id
"""
POLICIES = {"status": "coalesce_new", "price": "overwrite", "priority": "keep_old"}


@query("S09 J04 J05 J06", _MERGE_SQL)
def merge_policies(spark, sf):
    target, source = versions(spark, sf)
    return merge_upsert(target, source, ["id"], POLICIES)


@query("S09 J04", _MERGE_SQL)
def merge_small_source(spark, sf):
    """The same merge by probing the target."""
    target, source = versions(spark, sf)
    return merge_upsert(target, source, ["id"], POLICIES, small_source=True)


@query("S09 J04", _MERGE_SQL)
def merge_twice(spark, sf):
    """Merging the same batch again changes nothing."""
    target, source = versions(spark, sf)
    once = tables.written(merge_upsert(target, source, ["id"], POLICIES), new_path(spark, "merged"))
    return merge_upsert(once, source, ["id"], POLICIES)


@query("S10 J08", """
    SELECT o_orderkey AS id, CASE WHEN year(o_orderdate) < 2000 THEN 'old' ELSE 'new' END AS origin FROM orders
""")
def insert_if_absent(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "id")
    old = o.filter(F.year("o_orderdate") < 2000).select("id", F.lit("old").alias("origin"))
    batch = o.filter(F.year("o_orderdate") >= 1998).select("id", F.lit("new").alias("origin"))
    return insert_absent(old, batch.unionByName(batch), ["id"])


@query("S11", """
    SELECT l_partkey, max_by(l_quantity, l_orderkey * 10 + l_linenumber) AS quantity,
           max(l_orderkey * 10 + l_linenumber) AS seq
    FROM (SELECT l_partkey, l_quantity, l_orderkey, l_linenumber, row_number() OVER (
              PARTITION BY l_partkey, l_orderkey, l_linenumber ORDER BY l_quantity DESC, l_extendedprice DESC) r FROM lineitem)
    WHERE r = 1 GROUP BY l_partkey
""")
def last_row_wins(spark, sf):
    seq = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    df = table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice", seq.alias("seq"))
    return last_per_key(df, ["l_partkey"], ["seq", "l_quantity", "l_extendedprice"]) \
        .select("l_partkey", F.col("l_quantity").alias("quantity"), "seq")


@query("S12 S20", """
    SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS log_date FROM events
""")
def dated_log(spark, sf):
    path = new_path(spark, "log")
    tables.append_log(table(spark, sf, "events").select("event_id", "event_type", "ts"), path, "ts")
    return spark.read.parquet(path).select("event_id", "event_type", F.date_format("log_date", "yyyy-MM-dd").alias("log_date"))


@query("S14 S15", """
    SELECT conv_id, turn, role, length(text) AS chars FROM conversations
""")
def stage_records(spark, sf):
    path = new_path(spark, "records")
    df = table(spark, sf, "conversations")
    tables.write_records(df, path, "draft")
    back = tables.replay_records(spark, path, "draft", df.schema)
    return back.select("conv_id", "turn", "role", F.length("text").alias("chars"))


@query("S18", """
    SELECT c_custkey, CAST(NULL AS VARCHAR) AS status FROM customer
""")
def optional_state(spark, sf):
    state = tables.optional_table(spark, f"{sf}/no_such_table.parquet", "c_custkey long, status string")
    return table(spark, sf, "customer").select("c_custkey").join(state, "c_custkey", "left")


@query("S21 J21 P18", """
    SELECT o_orderkey AS id, o_orderstatus AS status FROM orders
""")
def snapshot_and_restore(spark, sf):
    current = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    saved = tables.snapshot(current, ["id"], ["status"], new_path(spark, "snapshot"))
    overwritten = current.withColumn("status", F.lit("?"))
    return restore_values(overwritten, saved, ["id"])


def responses(spark, sf):
    """Documents as answers of a reader service: pages, error envelopes, and text that is no JSON."""
    d = table(spark, sf, "documents")
    page = F.to_json(F.struct(F.lit(200).alias("code"), F.struct(
        F.col("text").alias("content"), F.concat(F.lit("https://x.test/"), F.col("doc_id").cast("string")).alias("url"),
        F.when(F.col("doc_id") % 5 == 0, 404).otherwise(200).alias("httpStatus"),
        F.create_map(F.lit("Home"), F.lit("https://x.test/"), F.lit("Mail"), F.lit("mailto:a@x.test"), F.lit(""), F.lit("x")).alias("links"),
        F.struct(F.col("n_chars").alias("tokens")).alias("usage")).alias("data")))
    error = F.lit('{"code":422,"name":"AssertionFailureError","message":"no such page"}')
    return d.select("doc_id", F.when(F.col("doc_id") % 7 == 3, error).when(F.col("doc_id") % 7 == 5, "<html>bad gateway")
                    .otherwise(page).alias("raw"))


_CONTENT = "trim(text, E' ')"


@query("S17 P09 P12", rf"""
    SELECT doc_id, CASE WHEN doc_id % 7 = 3 THEN 422 WHEN doc_id % 7 = 5 THEN 0 WHEN doc_id % 5 = 0 THEN 404 ELSE 200 END AS http_status,
           CASE WHEN doc_id % 7 = 3 THEN 'no such page' WHEN doc_id % 7 = 5 THEN 'unparseable response'
                WHEN length(trim(text)) = 0 THEN 'empty content'
                WHEN length(trim(text)) < 300 THEN 'content too short (' || length(trim(text)) || ' chars)' END AS fetch_error,
           CASE WHEN doc_id % 7 IN (3, 5) THEN NULL ELSE 'https://x.test/' || doc_id END AS final_url
    FROM documents
""")
def reader_answers(spark, sf):
    return reader.parse(responses(spark, sf)).select("doc_id", "http_status", "fetch_error", "final_url")


@query("D35 D36", """
    SELECT COUNT(*) * 2 AS links, COUNT(*) AS pages, CAST(SUM(n_chars) AS BIGINT) AS tokens
    FROM documents WHERE doc_id % 7 NOT IN (3, 5) AND length(trim(text)) >= 300
""")
def reader_links_and_tokens(spark, sf):
    parsed = reader.parse(responses(spark, sf))
    n = reader.link_rows(parsed, ["doc_id"]).agg(F.count(F.lit(1)).alias("links"))
    used = reader.token_usage(parsed)
    return used.select(n.scalar().alias("links"), "pages", "tokens")


@query("S17 P09", """
    SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, COUNT(*) AS n FROM events
    WHERE json_extract(props, '$.k') IS NOT NULL GROUP BY 1
""")
def variant_fields(spark, sf):
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k")
    return table(spark, sf, "events").select(k).filter("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("S19 ST01 ST05", """
    SELECT CASE WHEN event_type IN ('click', 'view') THEN event_type ELSE 'other' END AS event_class, COUNT(*) AS n
    FROM events GROUP BY 1
""")
def stream_classes(spark, sf):
    stream = ev.file_events(spark, sf).select("event_id", ev.classify(F.concat("event_type", F.lit(".x")), ("click", "view")).alias("event_class"))
    return ev.run_to_files(stream, spark, "classes").groupBy("event_class").agg(F.count(F.lit(1)).alias("n"))


def _signed(secret: str, message):
    """HMAC-SHA256 as hex, built from two SHA-256 calls, to play the sender."""
    key = secret.encode().ljust(64, b"\0")
    inner, outer = (F.lit(bytearray(x ^ pad for x in key)) for pad in (0x36, 0x5C))
    first = F.unhex(F.sha2(F.concat(inner, message.cast("binary")), 256))
    return F.sha2(F.concat(outer, first), 256)


@query("ST02 ST03", """
    SELECT CASE event_id % 10 WHEN 1 THEN 'no signature header' WHEN 2 THEN 'no digest in header' WHEN 3 THEN 'digest mismatch' END AS reject_reason,
           event_id % 50 = 0 AS is_ping, COUNT(*) AS n FROM events GROUP BY 1, 2
""")
def stream_gate(spark, sf):
    """Events as signed deliveries; every reject reason counted, pings told from real events."""
    body = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), "event_type", F.struct(
        F.when(F.col("event_id") % 50 == 0, "ping").alias("challenge")).alias("data")))
    digest = _signed("secret", F.concat_ws(".", F.lit("1704100000"), "body"))
    kind = F.col("event_id") % 10
    header = F.when(kind == 1, "").when(kind == 2, "t=1704100000").when(kind == 3, "t=1704100000,v1=00") \
        .otherwise(F.concat(F.lit("t=1704100000,v1=00,v1="), digest))
    raw = ev.file_events(spark, sf).select("event_id", body.alias("body")).withColumn("header", header)
    checked = ev.gate(raw, "secret", F.lit("2024-01-02").cast("timestamp"))
    event = checked.withColumn("data", F.from_json("body", EVENT)["data"])
    return ev.run_to_files(event.select("reject_reason", ev.is_challenge(event).alias("is_ping")), spark, "gate") \
        .groupBy("reject_reason", "is_ping").agg(F.count(F.lit(1)).alias("n"))


@query("ST04", """
    SELECT CAST(FLOOR(event_id / 2) AS BIGINT) AS id, COUNT(DISTINCT event_id % 2) >= 1 AS seen FROM events GROUP BY 1
""")
def stream_duplicates(spark, sf):
    """Every id arrives twice; the second one is suppressed."""
    stream = ev.file_events(spark, sf).select(F.floor(F.col("event_id") / 2).alias("id"), "at")
    once = ev.run_to_files(ev.deduplicate(stream, "id", "at", "30 days"), spark, "once")
    return once.select("id", F.lit(True).alias("seen"))


@query("ST06 ST07 ST08 S20", """
    SELECT event_type, COUNT(*) AS archived, COUNT(*) FILTER (WHERE event_type <> 'error' AND NOT (event_id % 10 = 3 AND event_type = 'view')) AS shown
    FROM events GROUP BY 1
""")
def stream_archive_and_feed(spark, sf):
    """All events archived; muted types and warm-up mail left out of the feed."""
    archive, feed, mark = (new_path(spark, x) for x in ("archive", "feed", "feed-progress"))
    muted = spark.createDataFrame([("error",)], "event_type string")
    events = ev.file_events(spark, sf).withColumn("event_type", F.when(F.col("event_type") == "view", "EMAIL_RECEIVED").otherwise(F.col("event_type"))) \
        .withColumn("data", F.struct(F.when(F.col("event_id") % 10 == 3, "Coffee? | warmup 33153D9").otherwise("x33153D9").alias("subject"),
                                     F.lit(None).cast("string").alias("preview")))
    ev.archive_and_feed(events, archive, feed, lambda: muted, mark).awaitTermination()
    kept = spark.read.parquet(archive).groupBy("event_type")
    shown = spark.read.parquet(feed).groupBy("event_type").agg(F.count(F.lit(1)).alias("shown"))
    both = kept.agg(F.count(F.lit(1)).alias("archived")).join(shown, "event_type", "left")
    return both.select(F.when(F.col("event_type") == "EMAIL_RECEIVED", "view").otherwise(F.col("event_type")).alias("event_type"),
                       "archived", F.coalesce("shown", F.lit(0)).alias("shown"))


@query("ST09 T05", """
    SELECT event_type, max_by(event_id, ts) AS event_id, max_by(props, ts) AS props FROM events GROUP BY 1
""")
def stream_latest_per_type(spark, sf):
    stream = ev.file_events(spark, sf).groupBy("event_type").agg(
        F.max_by(F.struct("event_id", "props"), F.struct("at", "event_id")).alias("v"))
    return ev.run_updates(stream, spark, "latest", ["event_type"]).select("event_type", "v.event_id", "v.props")


@query("F31 F38", """
    SELECT event_id, CASE WHEN event_type IN ('click', 'signup') THEN event_type ELSE 'other' END AS event_class,
           '**' || upper(event_type) || '** `user:' || user_id || '`' ||
             CASE WHEN event_id % 2 = 0 THEN ' · name=`n' || event_id || '`' ELSE ' · id=`' || event_id || '`' END AS summary
    FROM events
""")
def event_summaries(spark, sf):
    df = table(spark, sf, "events")
    payload = {"name": F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("n"), F.col("event_id").cast("string"))),
               "id": F.col("event_id").cast("string")}
    return df.select("event_id", ev.classify(F.col("event_type"), ("click", "signup")).alias("event_class"),
                     ev.summary(F.upper("event_type"), F.concat(F.lit("user:"), F.col("user_id").cast("string")), payload).alias("summary"))


@query("ST06 F38", """
    SELECT event_id, CASE event_type WHEN 'click' THEN 'user ' || user_id WHEN 'purchase' THEN upper(props) ELSE event_type END AS line
    FROM events WHERE contains(upper(event_type), 'CLICK') OR contains(upper(event_type), 'SIGN') OR contains(upper(event_type), 'PURCH')
""")
def event_formatters(spark, sf):
    """Per-type formatter expressions, checked against the schema before use."""
    df = table(spark, sf, "events").filter(ev.in_families(F.col("event_type"), "click, Sign,purch"))
    wanted = {"click": "concat('user ', user_id)", "purchase": "upper(props)", "signup": "no_such_column"}
    fine = {k: v for k, v in wanted.items() if ev.check_formatter(df, v) is None}
    return df.select("event_id", ev.formatted(df, fine, F.col("event_type")).alias("line"))


@query("ST13 A23", """
    SELECT event_type AS outcome, COUNT(*) AS n FROM events GROUP BY 1
""")
def stream_outcome_counts(spark, sf):
    from prospectra.streaming.health import outcome_counters
    out, mark = new_path(spark, "counts"), new_path(spark, "counts-progress")
    outcome_counters(ev.file_events(spark, sf).select(F.col("event_type").alias("outcome")), out, mark).awaitTermination()
    return spark.read.parquet(out).groupBy("outcome").agg(F.sum("n").alias("n"))


@query("W07 F09", r"""
    SELECT len(string_split(h, '/')) - 1 AS depth, FALSE AS unresolved, COUNT(*) AS n
    FROM (SELECT unnest(regexp_extract_all(html, '(?i)href\s*=\s*["'']([^"'']+)["'']', 1)) AS h FROM pages) GROUP BY 1
""")
def followed_links(spark, sf):
    """Links of all pages by resolved path depth."""
    found = page_signals.links(table(spark, sf, "pages"))
    depth = (F.size(F.split("target", "/")) - 3).cast("long")
    return found.groupBy(depth.alias("depth"), F.col("target").isNull().alias("unresolved")).agg(F.count(F.lit(1)).alias("n"))
