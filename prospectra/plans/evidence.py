"""Extracted people and angles held to what the pages say, and the confidence gate."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from prospectra.functions import emails as E
from prospectra.functions.identity import let
from prospectra.functions.patterns import pattern_hits
from prospectra.functions.text import find_payment_terms
from prospectra.operators.skew import pack_rows, salted_join
from prospectra.operators.stage import staged

# Words that show somebody owns or runs a business.
OWNERSHIP = (
    r"(?<!\w)(?:own|owns|owned|owner|owners|co-owner|co-owners|founder|founders|co-founder|founded"
    r"|started|start|ceo|president|director|partner|partners|manager|family business|our business"
    r"|my business)(?!\w)"
)
TITLE_REACH = 80
#: Claims that travel to a page in one array; a business with more has several arrays.
MAX_CLAIMS = 1000
THRESHOLD = 0.7


@F.pandas_udf(StringType())
def _compatible(texts: pd.Series) -> pd.Series:
    """Entities decoded and compatibility forms folded (NFKC), which Spark has no function for."""
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", html.unescape(t)))


def folded(text: Column) -> Column:
    """Text for matching quotes: quotes straightened, pictographs out, blanks collapsed, lower case.

    Plain ASCII without an entity folds to itself, so only other texts travel to Python.
    """
    c = F.coalesce(text, F.lit(""))
    foreign = c.rlike(r"[^\x00-\x7F]|&")
    c = F.when(foreign, F.translate(_compatible(F.when(foreign, c)), "‘’“”", "''\"\"")).otherwise(c)
    c = F.regexp_replace(c, r"[\p{So}\p{Sk}\p{Cf}\p{Mn}]", "")
    return F.lower(F.trim(F.regexp_replace(c, r"[\s\x{a0}]+", " ")))


def pieces(folded_quote: Column) -> Column:
    """The passages of a quote joined with an ellipsis."""
    return F.filter(F.split(folded_quote, r"\s*\.\.\.\s*"), lambda p: p != "")


def whole_phrase(phrase: Column) -> Column:
    """A pattern for the phrase as it is, with word boundaries."""
    return F.concat(F.lit(r"(?<!\w)\Q"), phrase, F.lit(r"\E(?!\w)"))


def near_hits(hits: Column, title: Column, title_size: Column, who: Column, who_size: Column, reach: int = TITLE_REACH) -> Column:
    """True when pattern ``title`` stands within ``reach`` characters of a whole ``who``; both are numbers of the hits' patterns.

    The title is a whole phrase within that stretch of text, so a word may go on beyond its ends.
    """
    def beside(m: Column) -> Column:
        first, last = F.greatest(m["start"] - reach, F.lit(0)), m["start"] + who_size + reach
        return F.exists(hits, lambda t: (t["k"] == title) & (t["start"] >= first) & (t["start"] + title_size <= last)
                        & (~t["left"] | (t["start"] == first)) & (~t["right"] | (t["start"] + title_size == last)))

    return F.exists(hits, lambda m: (m["k"] == who) & ~m["left"] & ~m["right"] & beside(m))


def title_near(hits: Column, k: Column, title: Column, name: Column, reach: int = TITLE_REACH) -> Column:
    """True when a title stands near a name or its first word: patterns ``k``, ``k + 2`` and ``k + 1`` of the hits."""
    first = F.substring_index(name, " ", 1)
    seen = lambda n: F.exists(hits, lambda h: h["k"] == n)
    by_first = near_hits(hits, k, F.length(title), k + 1, F.length(first), reach)
    by_name = near_hits(hits, k, F.length(title), k + 2, F.length(name), reach)
    possible = (title != "") & (first != "") & seen(k) & seen(k + 1)
    return F.when(possible, by_first | ((name != first) & by_name)).otherwise(False)


def title_near_name(title: Column, name: Column, page: Column, reach: int = TITLE_REACH) -> Column:
    """True when the title stands within ``reach`` characters of the name or its first word.

    All three are folded text. The page is read once for both.
    """
    hits = pattern_hits(page, F.array(title, F.substring_index(name, " ", 1), name))
    return let(hits, lambda h: title_near(h, F.lit(0), title, name, reach))


def shows_ownership(passage: Column, folded_name: Column) -> Column:
    """True when a passage both names the person and carries an ownership word."""
    first = F.substring_index(folded_name, " ", 1)
    return (first != "") & F.regexp_like(passage, whole_phrase(first)) & passage.rlike(OWNERSHIP)


def claims_of(research: DataFrame) -> DataFrame:
    """One row per statement to prove: a title beside a name, or a passage of a quote.

    ``research`` has one row per business with ``contacts`` and ``angle_evidence``.
    """
    def claim(kind: str, idx: Column, text: Column, who: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), idx.cast("int").alias("idx"), text.alias("text"), who.alias("who"))

    nobody = F.lit(None).cast("string")
    people = F.flatten(F.transform("contacts", lambda c, i: F.array(
        claim("title", i, c["title"], c["name"]), claim("quote", i, c["evidence"], c["name"]))))
    stated = F.concat(people, F.array(claim("angle", F.lit(-1), F.col("angle_evidence"), nobody)))
    wanted = F.filter(stated, lambda c: F.coalesce(c["text"], F.lit("")) != "")
    rows = research.select("business_id", F.explode(wanted).alias("c")).select("business_id", "c.*")
    # Text and name share one trip through the fold.
    both = staged(rows, {"_f": folded(F.concat("text", F.lit("\u0000"), F.coalesce("who", F.lit(""))))}, ("text", "who"))
    parts = staged(both, {
        "_text": F.trim(F.split_part("_f", F.lit("\u0000"), F.lit(1))), "who": F.trim(F.split_part("_f", F.lit("\u0000"), F.lit(2))),
    }, ("_f",))
    passages = F.when(F.col("kind") == "title", F.array("_text")).otherwise(pieces(F.col("_text")))
    split = parts.select("business_id", "idx", "kind", "who", F.posexplode(passages).alias("piece_no", "phrase"))
    return split.withColumn("owns", (F.col("kind") == "quote") & shows_ownership(F.col("phrase"), F.col("who")))


def prove(claims: DataFrame, pages: DataFrame) -> DataFrame:
    """(business_id, idx, kind) with ``proven``: every passage of the statement stands on some page.

    ``owns`` tells whether a passage shows ownership. The claims of a business travel to each
    of its pages in arrays of bounded size; an automaton of their phrases and names reads the
    folded page once per array, and what is near what is told from the places alone. Pages are
    never gathered.
    """
    packed = pack_rows(claims, ["business_id"], ["idx", "kind", "piece_no"], ["phrase", "who"], "_claims", MAX_CLAIMS).drop("chunk")
    texts = pages.select("business_id", "text").filter(F.col("text") != "")
    told = salted_join(texts, packed, ["business_id"], "inner", counts=texts.groupBy("business_id").count())
    seen = staged(told, {"_page": folded(F.col("text"))}, ("text",))
    words = F.flatten(F.transform("_claims", lambda c: F.when(
        c["kind"] == "title", F.array(c["phrase"], F.substring_index(c["who"], " ", 1), c["who"])).otherwise(F.array(c["phrase"], F.lit(None), F.lit(None)))))
    read = seen.withColumn("_hits", pattern_hits(F.col("_page"), words)).filter(F.size("_hits") > 0)
    judged = read.select("business_id", F.explode(F.transform("_claims", lambda c, i: F.struct(
        c["idx"].alias("idx"), c["kind"].alias("kind"), c["piece_no"].alias("piece_no"),
        F.when(c["kind"] == "title", title_near(F.col("_hits"), 3 * i, c["phrase"], c["who"]))
        .otherwise(F.exists("_hits", lambda h: h["k"] == 3 * i)).alias("hit"),
    ))).alias("_h")).select("business_id", "_h.*").filter("hit")
    keys = ["business_id", "idx", "kind"]
    per_piece = judged.groupBy(*keys, "piece_no").agg(F.max("hit").alias("hit"))
    found = claims.select(*keys, "piece_no", "owns").join(per_piece, [*keys, "piece_no"], "left")
    return found.groupBy(*keys).agg(
        F.min(F.coalesce("hit", F.lit(False))).alias("proven"), F.max("owns").alias("owns"))


def enforce(research: DataFrame, pages: DataFrame) -> DataFrame:
    """Research with unsupported titles and quotes removed; a decider must keep one proof.

    Gives the people as rows: business_id, idx, name, title, email, evidence,
    is_decision_maker.
    """
    claims = claims_of(research).filter(F.col("kind") != "angle")
    proofs = prove(claims, pages).groupBy("business_id", "idx").agg(
        F.max((F.col("kind") == "title") & F.col("proven")).alias("_title"),
        F.max((F.col("kind") == "quote") & F.col("proven")).alias("_quote"),
        F.max((F.col("kind") == "quote") & F.col("proven") & F.col("owns")).alias("_owns"),
    )
    people = research.select("business_id", F.posexplode("contacts").alias("idx", "c")) \
        .join(proofs, ["business_id", "idx"], "left")
    shown = F.coalesce(F.col("_title"), F.lit(False)) | F.coalesce(F.col("_owns"), F.lit(False))
    return people.select(
        "business_id", "idx", F.col("c.name").alias("name"), F.when(F.col("_title"), F.col("c.title")).alias("title"),
        F.col("c.email").alias("email"), F.when(F.col("_quote"), F.col("c.evidence")).alias("evidence"),
        (F.coalesce("c.is_decision_maker", F.lit(False)) & shown).alias("is_decision_maker"))


def enforce_angles(research: DataFrame, pages: DataFrame) -> DataFrame:
    """Angles whose quote is on the pages; a caution that carries payment terms is dropped."""
    proofs = prove(claims_of(research).filter(F.col("kind") == "angle"), pages).filter("proven")
    caution = F.when(find_payment_terms("angle_caution").isNull(), F.col("angle_caution"))
    return research.join(proofs.select("business_id"), "business_id", "left_semi") \
        .select("business_id", "angle_problem", "angle_evidence", caution.alias("angle_caution"))


def enforce_addresses(people: DataFrame, pool: DataFrame, pages: DataFrame) -> DataFrame:
    """People whose address is neither in the live pool nor stated on a page lose it."""
    live = pool.select("business_id", F.lower("email").alias("_e"))
    stated = pages.select("business_id", F.explode(E.stated_addresses(F.coalesce("text", F.lit("")))).alias("_e"))
    allowed = live.unionByName(stated).distinct().withColumn("_ok", F.lit(True))
    return people.withColumn("_e", F.lower("email")).join(allowed, ["business_id", "_e"], "left") \
        .withColumn("email", F.when(F.col("_ok"), F.col("email"))).drop("_e", "_ok")


def suggested_address(suggested: Column, live: Column) -> Column:
    """The suggested address when it is live, else the first live one; unchanged without a pool."""
    known = F.exists(live, lambda e: F.lower(e) == F.lower(suggested))
    return F.when((F.size(live) > 0) & ~known, F.get(live, F.lit(0))).otherwise(suggested)


def gate(c1: Column, next_url: Column, c2: Column, usable: Column, had_pool: Column, failed: Column,
         threshold: float = THRESHOLD) -> dict[str, Column]:
    """Status, reason and passes of a research result.

    ``c1`` and ``c2`` are the confidences of both passes, ``failed`` a failure reason or NULL.
    """
    dead = had_pool & ~usable
    none = F.lit(None).cast("string")
    escalates = F.coalesce(next_url, F.lit("")) != ""
    status = F.when(~dead & failed.isNull() & ((c1 >= threshold) | (escalates & (c2 >= threshold))), "researched") \
        .otherwise("rejected")
    reason = (
        F.when(dead, "no_verified_emails").when(failed.isNotNull(), failed).when(c1 >= threshold, none)
        .when(~escalates, "low_confidence_no_escalation_url").when(c2 >= threshold, none)
        .otherwise("low_confidence_after_two_passes")
    )
    passes = F.when(dead, 0).when((c1 >= threshold) | ~escalates | c1.isNull(), 1).otherwise(2)
    return {"status": status, "reason": reason, "passes": passes}
