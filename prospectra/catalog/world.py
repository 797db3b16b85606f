"""Lead tables derived from the given tables, in SQL that Spark and DuckDB read alike.

The given tables are not lead data. Customers become businesses, orders the
searches that found them, documents their crawled pages; every derived table
has one row per row of its source, so it grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prospectra.sources.tables import spread

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
NOW = "2026-01-15 12:00:00"


def pick(values: str, number: str) -> str:
    """SQL for one of the ``|``-separated values, chosen by a number."""
    n = values.count("|") + 1
    return f"split_part('{values}', '|', CAST(({number}) % {n} AS INT) + 1)"


def half(number: str, by: int) -> str:
    """SQL for integer division."""
    return f"CAST(FLOOR(({number}) / {by}) AS BIGINT)"


_K = "c.c_custkey"
WORLD = {
    # One business per customer.
    "biz": f"""
        SELECT {_K} AS id,
               {pick('Happy|Bright|River|Golden|Cedar|North', _K)} || ' ' ||
               {pick('Board and Train|Dog Training|K9 School|Pet Resort|Mobile Groom|Vet Clinic|Puppy Class|Dog Walkers|Luxury Day Care|Pet Store', _K)}
               || CASE WHEN {_K} % 4 = 0 THEN ', LLC' ELSE ' ' || CAST({half(_K, 50)} AS STRING) END AS name,
               {pick('Dog trainer|Kennel|Pet groomer|Veterinarian|Pet store|Dog walker|Dog park|Hospital|Pet service|Training center|Pet boarding service|Pet insurance', _K)} AS primary_category,
               {pick('Dog trainer|Veterinarian|Dog day care center|Pet supply store|Museum', _K)} AS second_category,
               CAST(35 + {_K} % 16 AS DOUBLE) / 10 AS rating,
               CASE WHEN {_K} % 9 = 0 THEN NULL ELSE COALESCE(o.n, 0) * 13 END AS review_count,
               CASE {_K} % 6 WHEN 0 THEN NULL
                    WHEN 1 THEN 'https://www.Site' || CAST({_K} % 300 AS STRING) || '.test/about?x=1'
                    WHEN 2 THEN 'site' || CAST({_K} % 300 AS STRING) || '.test'
                    WHEN 3 THEN 'http://shop.site' || CAST({_K} % 300 AS STRING) || '.co.test:8080/'
                    WHEN 4 THEN '(555) 010 ' || CAST({_K} AS STRING)
                    ELSE 'https://www.facebook.com/p' || CAST({_K} AS STRING) END AS website,
               CASE WHEN {_K} % 7 = 0 THEN NULL
                    WHEN {_K} % 2 = 0 THEN '+1 (555) ' || CAST(1000000 + {_K} % 800 AS STRING)
                    ELSE '555-' || CAST(1000000 + {_K} % 800 AS STRING) END AS phone,
               n.n_name AS city,
               {pick('CA|New York|TX|california|Ontario|', _K)} AS state,
               CASE WHEN {_K} % 8 = 0 THEN '$$' END AS price_range,
               CASE WHEN {_K} % 5 = 0 THEN 'Private lessons, one on one' END AS description,
               CASE {_K} % 3 WHEN 0 THEN TRUE END AS booking_present,
               CASE WHEN {_K} % 4 = 1 THEN CAST({_K} % 100 AS INT) END AS growth_score,
               CASE {_K} % 10 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS ads_confirmed_active,
               CASE {_K} % 10 WHEN 0 THEN CAST({_K} % 40 AS INT) WHEN 1 THEN CAST({_K} % 3 AS INT) END AS ads_creative_count,
               c.c_mktsegment AS segment, c.c_acctbal AS balance
        FROM {{customer}} c JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey
        LEFT JOIN (SELECT o_custkey, COUNT(*) AS n FROM {{orders}} GROUP BY o_custkey) o ON o.o_custkey = {_K}
    """,
    # One search hit per order: which search found which business.
    "hits": f"""
        SELECT o.o_orderkey AS hit_id, o.o_custkey AS business_id,
               {pick('dog trainer|dog boarding|pet groomer|vet clinic|pet store', 'o.o_orderkey')} AS term,
               {pick('dog_training|daycare_boarding|grooming|veterinary|pet_retail', 'o.o_orderkey')} AS service_category,
               CASE WHEN o.o_orderkey % 3 = 0 THEN 'Old Town, ' ELSE '' END || n.n_name || ', ST' AS geo_target,
               'phase' || CAST(o.o_orderkey % 2 AS STRING) AS phase,
               o.o_orderdate AS found_at, o.o_orderstatus AS status
        FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey
        JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey
    """,
    # One crawled page per document, three pages to a business.
    "crawl": f"""
        SELECT d.doc_id AS page_seq, {half('d.doc_id', 3)} AS business_id,
               'https://www.site' || CAST({half('d.doc_id', 3)} AS STRING) || '.test/p/' || CAST(d.doc_id AS STRING) AS url,
               {pick('home|about|contact|pricing|staff', 'd.doc_id')} AS page_kind,
               CASE WHEN d.doc_id % 11 = 5 THEN 404 ELSE 200 END AS http_status,
               'https://www.site' || CAST({half('d.doc_id', 3)} AS STRING) || '.test/' AS website,
               CASE WHEN d.doc_id % 13 = 7 THEN '' ELSE d.text ||
                 CASE d.doc_id % 4
                   WHEN 0 THEN ' Contact info@site' || CAST({half('d.doc_id', 3)} AS STRING) || '.test.'
                   WHEN 1 THEN ' (write Pat.Lee' || CAST(d.doc_id % 7 AS STRING) || '@gmail.com) or filler@godaddy.com, logo@2x.png'
                   WHEN 2 THEN ' Mail erin@site' || CAST({half('d.doc_id', 3)} AS STRING) || '.test; noreply@site1.test'
                   ELSE '' END ||
                 CASE WHEN {half('d.doc_id', 3)} % 5 = 1 THEN '; Erin ' || {pick('Kline|Hurst|Dorn|Frye|Tuck|Sato|Moreno', half('d.doc_id', 3))} || ', Owner of the place. '
                      WHEN d.doc_id % 5 = 2 THEN '. Every dog owner knows. Founder Dr. Ian ' || {pick('Dorn|Hale|Marsh', 'd.doc_id')} || ' trains. '
                      ELSE '' END END AS text
        FROM {{documents}} d
    """,
    # Health ticks: events of a user as ticks of a fleet.
    "ticks": f"""
        SELECT e.event_id AS tick_id, e.user_id AS fleet, e.ts AS checked_at,
               {pick('HEALTHY|WEDGED|WEDGED|PROXY_DEGRADED|WEDGED|IDLE', half('e.event_id', 200))} AS verdict,
               CASE e.event_type WHEN 'click' THEN 'restart' WHEN 'view' THEN 'proxy_refresh' ELSE 'none' END AS action,
               e.value > 20 AS action_ok
        FROM {{events}} e
    """,
}


# Tables whose rows carry whole texts: work on them is per row and heavy.
TEXT_TABLES = ("documents", "pages", "conversations", "crawl")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def world(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the derived tables."""
    df = spark.sql(WORLD[name].format(**{t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}))
    return spread(df) if name in TEXT_TABLES else df


def oracle(body: str, *names: str) -> str:
    """DuckDB text of a query over derived tables."""
    if not names:
        return body
    views = ", ".join(f"{n} AS ({WORLD[n].format(**{t: t for t in TABLES})})" for n in names)
    return f"WITH {views} {body}" if not body.lstrip().upper().startswith("WITH ") else \
        f"WITH {views}, {body.lstrip()[5:]}"
