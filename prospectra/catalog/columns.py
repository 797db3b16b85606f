"""Queries over single columns: identity, text, addresses, dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from prospectra.catalog.registry import query
from prospectra.catalog.world import table, world
from prospectra.functions import emails as E, identity as I, reviews as R, text as T
from prospectra.functions.regex import first_group
from prospectra.operators.stage import staged
from prospectra.plans import payloads
from prospectra.plans.pool import people_line, person_for, primary_contact

URL = r"^(?i)(https?)://(?:[^/?#@]*@)?([a-z0-9._-]+)(:[0-9]+)?([/?#].*)?$"


def duck_host(column: str) -> str:
    """DuckDB text of the host rule."""
    full = f"CASE WHEN regexp_matches(trim({column}), '(?i)^https?://') THEN trim({column}) ELSE 'https://' || trim({column}) END"
    return f"nullif(regexp_replace(lower(regexp_extract({full}, '{URL}', 2)), '^www\\.', ''), '')"


DOT_HOST = f"CASE WHEN contains({duck_host('website')}, '.') THEN {duck_host('website')} END"


@query("F01 F02 A25", f"""
    SELECT array_to_string(list_reverse(list_reverse(string_split(h, '.'))[1:2]), '.') AS domain,
           COUNT(*) AS pages, COUNT(DISTINCT h) AS hosts, MIN(url) AS first_url
    FROM (SELECT url, {duck_host('url')} AS h FROM pages) GROUP BY 1
""")
def site_domains(spark, sf):
    df = table(spark, sf, "pages").select("url", I.host("url").alias("h"))
    per_host = df.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("url").alias("u"))
    return per_host.groupBy(I.last_labels("h").alias("domain")).agg(
        F.sum("n").alias("pages"), F.count(F.lit(1)).alias("hosts"), F.min("u").alias("first_url"))


@query("F01 F03 F04 F05 F06", f"""
    SELECT id, {duck_host('website')} AS host, {DOT_HOST} AS dotted,
           lower(regexp_replace(regexp_replace(regexp_replace(website, '^https?://', ''), '/.*$', ''), '^www\\.', '')) AS by_replace,
           CASE WHEN length(d) = 11 AND d LIKE '1%' THEN substring(d, 2) WHEN length(d) >= 7 THEN d END AS phone_key,
           k || '|' || lower(regexp_replace(city, '[^A-Za-z0-9]', '', 'g')) || '|' ||
             regexp_replace(lower(coalesce(state, '')), '[^a-z0-9]+', '', 'g') AS name_key
    FROM (SELECT *, regexp_replace(phone, '[^0-9]', '', 'g') AS d,
                 regexp_replace(regexp_replace(lower(name), '\\b(llc|inc|corp|co)\\b\\.?', '', 'g'), '[^a-z0-9]+', '', 'g') AS k
          FROM biz)
""", ("biz",))
def business_identity(spark, sf):
    df = world(spark, sf, "biz")
    return df.select(
        "id", I.host("website", require_dot=False).alias("host"), I.host("website").alias("dotted"),
        I.host_by_replace("website").alias("by_replace"), I.phone_key("phone").alias("phone_key"),
        I.name_key("name", "city", "state").alias("name_key"))


@query("F07 F38 F41", """
    SELECT p_partkey,
           substring(regexp_replace(regexp_replace(lower(trim(p_name || ' & ' || p_brand)), '[^a-z0-9_\\s-]', '', 'g'), '\\s+', '_', 'g'), 1, 100) AS file_slug,
           regexp_replace(regexp_replace(lower(p_type || '_' || p_brand), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS event_slug,
           upper(regexp_replace(trim(p_name), '[\\s-]+', '_', 'g')) AS event_key,
           regexp_replace(regexp_replace(lower(p_name || '#' || p_brand), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS safe_name
    FROM part
""")
def slugs(spark, sf):
    df = table(spark, sf, "part")
    return df.select(
        "p_partkey", I.file_slug(F.concat_ws(" & ", "p_name", "p_brand")).alias("file_slug"),
        I.event_slug(F.concat_ws("_", "p_type", "p_brand")).alias("event_slug"),
        I.event_key("p_name").alias("event_key"),
        I.safe_name(F.concat_ws("#", "p_name", "p_brand")).alias("safe_name"))


@query("F08", f"""
    SELECT id, CASE WHEN contains(h, '.') THEN lower(regexp_extract(f, '{URL}', 1)) || '://' || h ||
           regexp_extract(f, '{URL}', 3) ||
           CASE WHEN regexp_extract(f, '{URL}', 4) LIKE '/%' THEN regexp_extract(f, '{URL}', 4)
                ELSE '/' || regexp_extract(f, '{URL}', 4) END END AS page_url
    FROM (SELECT id, f, regexp_extract(f, '{URL}', 2) AS h FROM (
        SELECT id, CASE WHEN regexp_matches(website, '(?i)^https?://') THEN website ELSE 'https://' || website END AS f FROM biz))
""", ("biz",))
def normalised_urls(spark, sf):
    return world(spark, sf, "biz").select("id", I.page_url("website").alias("page_url"))


HTML_CHAIN = """regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    regexp_replace(regexp_replace(regexp_replace(html, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', ' ', 'g'),
    '(?is)<script.*?</script>', ' ', 'g'), '(?is)<style.*?</style>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'),
    '<[^>]+>', ' ', 'g'), '&nbsp;', ' ', 'g'), '&amp;', '&', 'g'), '&(?:#39|rsquo|apos);', '''', 'g'),
    '&(?:quot|ldquo|rdquo);', '"', 'g'), '[\\s\\x{a0}]+', ' ', 'g')"""


@query("F10 F11 F12 P11", f"""
    SELECT page_id, length(t) AS chars, md5(t) AS digest,
           length(html) > 500 AS usable, md5(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '&#0?39;|&apos;|&rsquo;', chr(39), 'g'), '&quot;|&ldquo;|&rdquo;', '"', 'g'), '&amp;', '&'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>')) AS decoded
    FROM (SELECT page_id, html, trim({HTML_CHAIN}) AS t FROM pages)
""")
def page_texts(spark, sf):
    df = table(spark, sf, "pages").withColumn("t", T.html_to_text("html"))
    return df.select(
        "page_id", F.length("t").alias("chars"), F.md5(F.col("t").cast("binary")).alias("digest"),
        T.is_usable_page(F.lit(200), F.col("html"), F.col("t")).alias("usable"),
        F.md5(T.decode_entities("html").cast("binary")).alias("decoded"))


@query("P11 P12", r"""
    SELECT page_seq, http_status,
           length(text) > 500 AND (http_status BETWEEN 200 AND 399 OR length(text) >= 400) AS usable,
           CASE WHEN length(trim(text)) = 0 THEN 'empty content'
                WHEN length(trim(text)) < 300 THEN 'content too short (' || length(trim(text)) || ' chars)' END AS content_error
    FROM crawl
""", ("crawl",))
def content_gates(spark, sf):
    df = world(spark, sf, "crawl")
    return df.select(
        "page_seq", "http_status",
        T.is_usable_page(F.col("http_status"), F.col("text"), F.col("text")).alias("usable"),
        T.content_error(F.col("text")).alias("content_error"))


def duck_addresses(text: str) -> str:
    """DuckDB text of the distinct tidy addresses of a text."""
    found = f"regexp_extract_all({text}, '{E.ADDRESS}')"
    return f"list_distinct(list_transform({found}, lambda x: regexp_replace(lower(x), '[.,;:)\\]}}>''\"]+$', '')))"


def duck_reject(email: str, domains: tuple[str, ...] = E.INFRASTRUCTURE_DOMAINS) -> str:
    """DuckDB text of the reject rules."""
    local = f"split_part({email}, '@', 1)"
    junk = "|".join(d.replace(".", "\\.") for d in domains) or "(?!)"
    listed = ", ".join(f"'{x}'" for x in E.PLACEHOLDER_LOCALS)
    return f"""CASE WHEN strpos({email}, '@') < 2 THEN 'malformed'
        WHEN regexp_matches({email}, '{E.ASSET_NAME}') THEN 'asset filename'
        WHEN {local} IN ({listed}) THEN 'placeholder local part'
        WHEN regexp_matches(substring({email}, strpos({email}, '@') + 1), '(?i)(?:^|\\.)(?:{junk})$') THEN 'infrastructure domain'
        WHEN length({local}) > 40 THEN 'implausibly long local part'
        WHEN length({email}) > 254 THEN 'exceeds maximum email length'
        WHEN regexp_matches({local}, '^[0-9a-f]{{16,}}$') THEN 'hex token'
        WHEN NOT regexp_matches({local}, '[a-z]') THEN 'no letters in local part' END"""


# The demonstration data puts all its addresses on example domains.
DEMO_JUNK = tuple(d for d in E.INFRASTRUCTURE_DOMAINS if not d.startswith("example."))
ROLE_SQL = ", ".join(f"'{x}'" for x in E.ROLE_LOCALS)
FREE_SQL = ", ".join(f"'{x}'" for x in E.FREE_MAIL_LABELS)


@query("F13 F14 F15 F45", f"""
    SELECT doc_id, email, {duck_reject('email')} AS default_reason, {duck_reject('email', DEMO_JUNK)} AS reason,
           split_part(email, '@', 1) IN ({ROLE_SQL}) AS is_role,
           split_part(split_part(email, '@', 2), '.', 1) IN ({FREE_SQL}) AS is_free_mail
    FROM (SELECT doc_id, unnest({duck_addresses('text')}) AS email FROM documents)
""")
def document_addresses(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", F.explode(E.addresses_in("text")).alias("email"))
    return df.select(
        "doc_id", "email", E.reject_reason("email").alias("default_reason"),
        E.reject_reason("email", DEMO_JUNK).alias("reason"), E.is_role("email").alias("is_role"),
        E.is_free_mail(I.email_domain("email")).alias("is_free_mail"))


@query("F17 F46", f"""
    SELECT email, COUNT(*) AS n, split_part(email, '@', 2) AS domain,
           NOT list_contains([{", ".join(f"'{x}'" for x in E.DESK_LOCALS)}], l) AND
             (regexp_matches(l, '^[a-z]{{2,}}(?:[._-][a-z]+)?$') OR regexp_matches(l, '^[a-z][._-][a-z]{{2,}}$')) AS is_person,
           split_part(email, '@', 2) IN ({", ".join(f"'{x}'" for x in E.FREE_MAIL_DOMAINS)}) AS free_domain
    FROM (SELECT email, regexp_replace(split_part(email, '@', 1), '[0-9]+$', '') AS l
          FROM (SELECT unnest({duck_addresses('text')}) AS email FROM crawl))
    GROUP BY ALL
""", ("crawl",))
def address_shapes(spark, sf):
    df = world(spark, sf, "crawl").select(F.explode(E.addresses_in("text")).alias("email"))
    return df.groupBy("email").agg(F.count(F.lit(1)).alias("n")).select(
        "email", "n", I.email_domain("email").alias("domain"), E.is_person_shaped(F.col("email")).alias("is_person"),
        E.is_free_mail_domain(I.email_domain("email")).alias("free_domain"))


@query("F05", r"""
    SELECT doc_id, phone, CASE WHEN length(d) = 11 AND d LIKE '1%' THEN substring(d, 2) ELSE d END AS phone_key
    FROM (SELECT doc_id, phone, regexp_replace(phone, '[^0-9]', '', 'g') AS d FROM (
        SELECT doc_id, unnest(regexp_extract_all(text, '\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}')) AS phone FROM documents))
""")
def document_phones(spark, sf):
    shape = r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}"
    df = table(spark, sf, "documents").select(
        "doc_id", F.explode(F.regexp_extract_all("text", F.lit(shape), F.lit(0))).alias("phone"))
    return df.withColumn("phone_key", I.phone_key("phone"))


MONTHLY = "n / (greatest(span, 30.0) / 30.44)"


GROWTH_SQL = f"""
    WITH s AS (SELECT o_custkey, COUNT(*) AS n, MAX(o_orderdate) AS newest, MIN(o_orderdate) AS oldest,
                      date_diff('day', MAX(o_orderdate), TIMESTAMP '2000-06-30') AS since,
                      date_diff('day', MIN(o_orderdate), MAX(o_orderdate))::DOUBLE AS span
               FROM orders WHERE o_orderdate <= TIMESTAMP '2000-06-30' GROUP BY o_custkey),
    p AS (SELECT *, CASE WHEN since <= 30 THEN 50 WHEN since <= 90 THEN 40 WHEN since <= 180 THEN 28
                         WHEN since <= 365 THEN 15 WHEN since <= 730 THEN 5 ELSE 0 END
                  + CASE WHEN {MONTHLY} >= 4 THEN 50 WHEN {MONTHLY} >= 2 THEN 40 WHEN {MONTHLY} >= 1 THEN 30
                         WHEN {MONTHLY} >= 0.5 THEN 20 WHEN {MONTHLY} >= 0.25 THEN 10 ELSE 4 END AS score FROM s)"""


@query("F19 A09", f"""{GROWTH_SQL}
    SELECT o_custkey, CASE WHEN n >= 3 THEN score END AS growth_score,
           CASE WHEN n >= 3 THEN n >= 8 AND span < 30 END AS capped,
           CASE WHEN n >= 3 THEN CAST(least(80, floor(score / 20) * 20) AS INTEGER) END AS bucket FROM p
""")
def order_growth(spark, sf):
    now = R.as_time("2000-06-30 00:00:00")
    at = F.col("o_orderdate").cast("timestamp")
    stats = table(spark, sf, "orders").filter(at <= now).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.min(at).alias("oldest"), F.max(at).alias("newest"))
    g = R.growth(F.col("n"), F.col("oldest"), F.col("newest"), now)
    return stats.select("o_custkey", g["growth_score"].alias("growth_score"), g["capped"].alias("capped"),
                        R.histogram_bucket(g["growth_score"]).alias("bucket"))


@query("F20 F21 P06", """
    SELECT event_id, CASE WHEN s BETWEEN 946684800 AND 4102444800 THEN s END AS epoch,
           CASE WHEN s BETWEEN 946684800 AND 4102444800 THEN 1704700800 - s <= 30 * 86400 ELSE FALSE END AS recent,
           ts <= TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 7 DAY AS stale
    FROM (SELECT event_id, ts, 1690000000 + event_id * 7919 * CASE WHEN event_id % 10 = 0 THEN 1000000 ELSE 1 END AS s FROM events)
""")
def epoch_windows(spark, sf):
    factor = F.when(F.col("event_id") % 10 == 0, 1_000_000).otherwise(1)
    at = R.epoch_seconds((F.lit(1690000000) + F.col("event_id") * 7919 * factor).cast("string"))
    now = R.as_time("2024-01-08 08:00:00")
    return table(spark, sf, "events").select(
        "event_id", F.unix_seconds(at).alias("epoch"), R.within_days(at, now).alias("recent"),
        R.is_stale(F.col("ts").cast("timestamp"), R.as_time("2024-01-15 12:00:00"), 7).alias("stale"))


@query("F29 F30 D30", r"""
    SELECT conv_id, turn, length(text) AS body_chars, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS body_words,
           len(list_filter(regexp_split_to_array(text, '\n\s*\n'), lambda p: trim(p, E' \n\t') <> '')) AS paragraphs,
           contains(text, '?') AS has_question, contains(lower(text), lower(role)) AS mentions_business,
           regexp_matches(text, '&(?:[a-zA-Z]{2,8}|#[0-9]{1,6}|#x[0-9a-fA-F]{1,6});') AS has_entity
    FROM conversations
""")
def draft_measures(spark, sf):
    df = table(spark, sf, "conversations")
    m = T.draft_metrics(F.lit(""), F.col("text"), F.col("role"))
    return df.select(
        "conv_id", "turn", m["body_chars"].alias("body_chars"), m["body_words"].alias("body_words"),
        m["paragraphs"].alias("paragraphs"), m["has_question"].alias("has_question"),
        m["mentions_business"].alias("mentions_business"), (F.size(m["html_entities"]) > 0).alias("has_entity"))


@query("F29 F30 D30", rf"""
    WITH d AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 2 THEN repeat('s', 91) ELSE '' END AS subject, text || CASE (conv_id + turn) % 6 WHEN 1 THEN chr(10) || 'Thanks,' || chr(10) || 'Pat'
            WHEN 2 THEN ' **bold** claim.' WHEN 3 THEN ' Salt &amp; pepper.' WHEN 4 THEN chr(10) || 'Cheers' WHEN 5 THEN ' (see above.)' ELSE '' END AS body FROM conversations),
    l AS (SELECT *, len(list_filter(regexp_split_to_array(body, '\s+'), lambda w: w <> '')) AS n,
                 list_filter(list_transform(string_split(body, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS lines FROM d),
    j AS (SELECT *, lines[-1] AS last, len(list_filter(regexp_split_to_array(lines[-1], '\s+'), lambda w: w <> '')) <= 3 AS short FROM l),
    f AS (SELECT conv_id, turn, list_filter([CASE WHEN n = 0 THEN 'empty_body' END,
        CASE WHEN n > 0 AND right(regexp_replace(CASE WHEN len(lines) > 1 AND short THEN lines[-2] ELSE last END, '["'')\]”’]+$', ''), 1) NOT IN ('.', '!', '?') THEN 'unterminated_body' END,
        CASE WHEN n > 0 AND n < 25 THEN 'body_too_short' END, CASE WHEN n > 250 THEN 'body_too_long' END, CASE WHEN length(subject) > 90 THEN 'subject_too_long' END,
        CASE WHEN regexp_matches(regexp_replace(body, '\p{{Latin}}', '', 'g'), '\p{{L}}') OR regexp_matches(body, '[ªºＡ-Ｚａ-ｚ]') THEN 'non_latin_script' END,
        CASE WHEN regexp_matches(body, '&(?:[a-zA-Z]{{2,8}}|#[0-9]{{1,6}}|#x[0-9a-fA-F]{{1,6}});') THEN 'html_entity' END,
        CASE WHEN regexp_matches(body, '(?m)(?:\*\*[^*\n]+\*\*|^#{{1,6}}\s|^\s*[-*]\s+\S|\[[^\]\n]+\]\([^)\n]+\))') THEN 'markdown' END,
        CASE WHEN (len(lines) > 1 AND regexp_matches(last, '{T.SIGN_OFF}')) OR (len(lines) > 2 AND regexp_matches(lines[-2], '{T.SIGN_OFF}') AND short AND right(last, 1) NOT IN ('.', '?', '!')) THEN 'sign_off' END
        ], lambda x: x IS NOT NULL) AS failures FROM j)
    SELECT conv_id, turn, array_to_string(failures, ',') AS failures, len(failures) = 0 AS passed FROM f
""")
def draft_verdicts(spark, sf):
    """Ordered failure list of every conversation turn read as a draft, some with a planted fault."""
    from prospectra.plans.draft_qa import verdicts
    k = (F.col("conv_id") + F.col("turn")) % 6
    planted = F.when(k == 1, "\nThanks,\nPat").when(k == 2, " **bold** claim.").when(k == 3, " Salt &amp; pepper.") \
        .when(k == 4, "\nCheers").when(k == 5, " (see above.)").otherwise("")
    df = table(spark, sf, "conversations").withColumn("body", F.concat("text", planted)) \
        .withColumn("subject", F.when(F.col("turn") % 3 == 2, F.repeat(F.lit("s"), F.lit(91))).otherwise(""))
    return verdicts(df).select("conv_id", "turn", F.array_join("failures", ",").alias("failures"), "passed")


@query("F29", f"""
    SELECT doc_id, nullif(regexp_extract(text, '({T.PAYMENT_OR_PROMISE})', 1), '') AS promise,
           nullif(regexp_extract(text, '({T.PAYMENT_TERMS})', 1), '') AS terms,
           len(regexp_extract_all(text, '{T.BRACKETED}')) > 0 AS bracketed
    FROM (SELECT doc_id, text || CASE WHEN doc_id % 9 = 0 THEN ' You pay only for results, risk-free.'
                                      WHEN doc_id % 9 = 1 THEN ' We guarantee it.' ELSE '' END AS text FROM documents)
""")
def payment_wording(spark, sf):
    extra = F.when(F.col("doc_id") % 9 == 0, " You pay only for results, risk-free.") \
        .when(F.col("doc_id") % 9 == 1, " We guarantee it.").otherwise("")
    df = table(spark, sf, "documents").withColumn("text", F.concat("text", extra))
    return df.select("doc_id", T.find_payment_or_promise("text").alias("promise"),
                     T.find_payment_terms("text").alias("terms"), F.col("text").rlike(T.BRACKETED).alias("bracketed"))


def _route_sql() -> str:
    parts = []
    for name, words in T.ROUTES.items():
        hits = " + ".join(f"CAST(contains(t, '{w}') AS INT)" for w in words)
        parts.append(f"({hits}) AS s_{name}")
    top = "greatest(s_frontier, s_code, s_mid, s_cheap)"
    return f"""SELECT conv_id, turn, CASE WHEN {top} = 0 THEN 'cheap' WHEN s_frontier = {top} THEN 'frontier'
        WHEN s_code = {top} THEN 'code' WHEN s_mid = {top} THEN 'mid' ELSE 'cheap' END AS route
        FROM (SELECT conv_id, turn, {", ".join(parts)} FROM (SELECT conv_id, turn, lower(text) AS t FROM conversations))"""


@query("F32", _route_sql())
def prompt_routes(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", T.keyword_route("text", T.ROUTES, "cheap").alias("route"))


_NS = payloads.DRAFT_NAMESPACE.replace("-", "")


@query("F33", f"""
    SELECT id, substring(d, 1, 8) || '-' || substring(d, 9, 4) || '-5' || substring(d, 14, 3) || '-' ||
           substring('89ab', CAST(strpos('0123456789abcdef', substring(d, 17, 1)) - 1 AS INT) % 4 + 1, 1) ||
           substring(d, 18, 3) || '-' || substring(d, 21, 12) AS draft_id,
           'key-' || substring(sha256(name || coalesce(phone, '')), 1, 16) AS content_key
    FROM (SELECT id, name, phone, sha1(unhex('{_NS}') || encode(CAST(id AS VARCHAR) || ':' || lower(trim(name)))) AS d FROM biz)
""", ("biz",))
def stable_keys(spark, sf):
    df = world(spark, sf, "biz")
    return df.select(
        "id", payloads.draft_id(F.col("id"), F.col("name")).alias("draft_id"),
        I.content_key(F.lit("key"), F.concat("name", F.coalesce("phone", F.lit("")))).alias("content_key"))


@query("F24 F25 F34", r"""
    SELECT id, split_part(name, ' ', 1) AS first_name, trim(substring(name, length(split_part(name, ' ', 1)) + 1)) AS rest,
           split_part(lower(segment) || '/' || lower(city) || '-7b:x', '/', 1) AS provider,
           regexp_extract(lower(city) || '-7b:x', '^([^-:.]*)', 1) AS family,
           CASE WHEN booking_present THEN 'true' ELSE '' END || ';' || CAST(round(balance, 0) AS BIGINT) AS fields
    FROM biz
""", ("biz",))
def text_fields(spark, sf):
    df = world(spark, sf, "biz")
    model = F.concat(F.lower("segment"), F.lit("/"), F.lower("city"), F.lit("-7b:x"))
    first, rest = I.first_and_rest("name")
    fields = T.non_empty_map({"a": T.as_text(F.col("booking_present"), "boolean"),
                              "b": T.as_text(F.round("balance", 0).cast("long"), "int")})
    return df.select("id", first.alias("first_name"), rest.alias("rest"), I.provider_of(model).alias("provider"),
                     I.model_family(model).alias("family"),
                     F.concat(F.coalesce(F.try_element_at(fields, F.lit("a")), F.lit("")), F.lit(";"),
                              F.try_element_at(fields, F.lit("b"))).alias("fields"))


@query("F39", """
    SELECT event_id, replace(replace(props || ' ' || event_type, 'purchase', 'order'), 'k', 'count') AS shown FROM events
""")
def named_ids(spark, sf):
    text = F.concat_ws(" ", "props", "event_type")
    return table(spark, sf, "events").select("event_id", T.replace_known_ids(text, {"k": "count", "purchase": "order"}).alias("shown"))


@query("F42 F22", """
    SELECT o_custkey, string_agg(s, ',' ORDER BY s) AS statuses
    FROM (SELECT DISTINCT o_custkey, lower(trim(' ' || o_orderstatus || ' ')) AS s FROM orders) GROUP BY o_custkey
""")
def normalised_lists(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", F.concat(F.lit(" "), "o_orderstatus", F.lit(" ")).alias("s")).distinct()
    lists = df.groupBy("o_custkey").agg(F.collect_list("s").alias("l"))
    return lists.select("o_custkey", F.array_join(F.array_sort(E.normalise_list(F.col("l"))), ",").alias("statuses"))


_PEOPLE = "array<struct<name:string,title:string,email:string,is_decision_maker:boolean,evidence:string>>"


def _demo_contacts():
    """Two invented people per business, derived from its columns."""
    return F.array(
        F.struct(F.concat(F.lit("Wyatt "), "city").alias("name"), F.when(F.col("id") % 2 == 0, "Trainer").alias("title"),
                 F.lit(None).cast("string").alias("email"), F.lit(False).alias("is_decision_maker"),
                 F.lit(None).cast("string").alias("evidence")),
        F.struct(F.concat(F.lit("Laura "), "segment").alias("name"), F.lit("Owner").alias("title"),
                 F.when(F.col("id") % 3 == 0, F.concat(F.lit("l"), F.col("id").cast("string"), F.lit("@x.test"))).alias("email"),
                 (F.col("id") % 5 != 0).alias("is_decision_maker"), F.lit(None).cast("string").alias("evidence")),
    ).cast(_PEOPLE)


@query("F44 W15 D22", """
    SELECT id, CASE WHEN id % 4 = 0 THEN 'Wyatt ' || city WHEN id % 4 = 1 AND id % 3 = 0 THEN 'Laura ' || segment END AS person,
           CASE WHEN id % 5 <> 0 THEN 'Laura ' || segment ELSE 'Wyatt ' || city END AS primary_name,
           'Wyatt ' || city || ' (' || CASE WHEN id % 2 = 0 THEN 'Trainer' ELSE 'no title stated' END || '), Laura ' || segment ||
           ' (Owner' || CASE WHEN id % 5 <> 0 THEN '; decides on spending' ELSE '' END ||
           CASE WHEN id % 3 = 0 THEN '; l' || id || '@x.test' ELSE '' END || ')' AS people
    FROM biz
""", ("biz",))
def contact_lines(spark, sf):
    df = world(spark, sf, "biz").withColumn("contacts", _demo_contacts())
    address = F.when(F.col("id") % 4 == 0, "wyatt.s@x.test") \
        .when(F.col("id") % 4 == 1, F.concat(F.lit("L"), F.col("id").cast("string"), F.lit("@x.test"))).otherwise("info@x.test")
    return df.select("id", person_for(address, F.col("contacts"))["name"].alias("person"),
                     primary_contact(F.col("contacts"))["name"].alias("primary_name"),
                     people_line(F.col("contacts")).alias("people"))


@query("F44 F46", """
    SELECT id, 'info@site.test (' || CASE id % 3 WHEN 0 THEN 'valid: the mailbox accepted it' WHEN 1 THEN 'unchecked: not checked'
           ELSE 'invalid: the mailbox does not exist' END || '; shared inbox' ||
           CASE WHEN id % 2 = 0 THEN '' ELSE '; not on their website''s domain' END || ')' AS line
    FROM biz
""", ("biz",))
def address_lines(spark, sf):
    i = F.col("id")
    verified = F.when(i % 3 == 0, True).when(i % 3 == 2, False)
    own = F.when(i % 2 == 0, "site.test").otherwise("other.test")
    return world(spark, sf, "biz").select("id", E.describe_address(
        F.lit("info@site.test"), verified, F.lit("5.1.1 no such user"), F.lit(True), own).alias("line"))


@query("F26 F27", r"""
    WITH w AS (SELECT doc_id, text, string_split_regex(trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), '\s+') AS t FROM documents)
    SELECT doc_id, len(t) >= 2 AS first_words, len(t) >= 2 AND doc_id % 3 <> 0 AS both_ends, FALSE AS invented FROM w
""")
def quotes_on_page(spark, sf):
    """Passages of every document looked for in its folded text: its own words, both ends around an ellipsis, and invented ones."""
    from prospectra.plans.evidence import folded, pieces
    df = staged(table(spark, sf, "documents").select("doc_id", "text"), {"page": folded(F.col("text"))})
    two = r"(?s)^\s*(\S+\s+\S+)"
    head = first_group(F.col("text"), two)
    tail = F.reverse(first_group(F.reverse(F.col("text")), two))  # from the end, so that no word before is tried
    tail = F.when(F.col("doc_id") % 3 == 0, F.concat(tail, F.lit(" zq"), F.col("doc_id"))).otherwise(tail)
    quotes = {"first_words": F.regexp_replace(head, r"\s+", " \t "), "both_ends": F.concat(head, F.lit(" ... "), tail), "invented": F.lit("zq xj qv of the zz")}
    # Each quote is made and folded once, whatever mentions it.
    told = staged(staged(df, quotes, ("text",)), {n: folded(F.col(n)) for n in quotes})
    split = staged(told, {n: pieces(F.col(n)) for n in quotes})
    stands = lambda n: F.coalesce(F.forall(F.col(n), lambda p: F.contains(F.col("page"), p)) & (F.size(n) > 0), F.lit(False))
    return split.select("doc_id", *[stands(n).alias(n) for n in quotes])


@query("F40 P16", """
    SELECT l_orderkey, l_linenumber, CAST(round(l_quantity / 4) AS BIGINT) AS rounded,
           CAST(least(100, greatest(0, l_quantity * 4 - 60)) AS BIGINT) AS clamped FROM lineitem
""")
def rounded_and_clamped(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(F.col("l_quantity") / 4).cast("long").alias("rounded"),
        E.clamp(F.col("l_quantity") * 4 - 60).cast("long").alias("clamped"))
