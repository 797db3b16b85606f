"""Address pools: dead addresses out, pages against pool, recipient and greeting.

Contacts are the short list of people research found for a business, held as
``array<struct<name,title,email,is_decision_maker,evidence>>`` in its one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.functions import emails as E
from prospectra.operators.skew import pack_rows, salted_join
from prospectra.operators.stage import staged
from prospectra.session import new_path
from prospectra.sources.tables import written

#: Addresses of a business that travel to a page in one array; a larger pool has several arrays.
MAX_POOL = 1000
CONTACTS = "array<struct<name:string,title:string,email:string,is_decision_maker:boolean,evidence:string>>"


def split_undeliverable(pool: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, proven dead). Only a dead mailbox goes; an unfinished check proves nothing."""
    status = E.deliverability(F.col("verified"), F.col("verification_error"))
    return pool.filter(status != "invalid"), pool.filter(status == "invalid")


def live_pool(pool: DataFrame, pages: DataFrame) -> DataFrame:
    """Adds ``on_page`` and ``kept`` to pool rows (business_id, email, verified, verification_error, is_role).

    When the pages show some of a pool but not all, an address they omit is
    dropped, unless the mailbox accepted it or its first local-part word is a
    person's name standing on the pages.
    """
    address = F.lower("email")
    first = F.split(E.local_part("email"), "[._+-]", 2)[0]
    personal = F.coalesce(~F.col("is_role"), F.lit(False)) & first.rlike(r"^\p{L}{3,}$")
    asked = pool.select("business_id", address.alias("_e"), F.when(personal, F.lower(first)).alias("_word"))
    packed = pack_rows(asked.distinct(), ["business_id"], ["_e"], ["_word"], "_pool", MAX_POOL).drop("chunk")
    text = F.coalesce("text", F.lit(""))
    told = salted_join(pages.select("business_id", "text").filter(text != ""), packed, ["business_id"], "inner")
    # Every page is read once: which of its business's addresses it states, and which of their names it says.
    read = staged(told, {"_stated": E.stated_addresses(text), "_words": F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"))}, ("text",))
    facts = read.select("business_id", F.explode(F.transform("_pool", lambda x: F.struct(
        x["_e"].alias("_e"), F.array_contains("_stated", x["_e"]).alias("on"), F.coalesce(F.array_contains("_words", x["_word"]), F.lit(False)).alias("named"),
    ))).alias("_f")).select("business_id", "_f.*").filter("on OR named")
    found = written(facts.groupBy("business_id", "_e").agg(F.max("on").alias("_on"), F.max("named").alias("_named")), new_path(pool.sparkSession, "page-facts"))

    shown = found.filter("_on").groupBy("business_id").agg(F.count(F.lit(1)).alias("_shown"))
    sizes = pool.groupBy("business_id").agg(F.count(F.lit(1)).alias("count"), F.count_if(address.isNull()).alias("_none"), F.count_distinct(address).alias("_all"))
    # Some shown and some not: told by distinct addresses, so rows need no second join.
    partly = sizes.join(shown, "business_id", "left").select("business_id", "count", (F.coalesce("_shown", F.lit(0)).between(1, F.col("_all") + F.col("_none").cast("boolean").cast("int") - 1)).alias("_partly"))
    partly = written(partly, new_path(pool.sparkSession, "pool-sizes"))
    rows = salted_join(pool, partly.drop("count"), ["business_id"], "inner", counts=partly.drop("_partly"))
    rows = rows.withColumn("_e", address).join(found, ["business_id", "_e"], "left").withColumn("on_page", F.coalesce("_on", F.lit(False)))
    valid = E.deliverability(F.col("verified"), F.col("verification_error")) == "valid"
    kept = ~F.col("_partly") | F.col("on_page") | valid | F.coalesce("_named", F.lit(False))
    return rows.withColumn("kept", kept).select(*pool.columns, "on_page", "kept")


def person_for(email: Column, contacts: Column) -> Column:
    """The contact an address belongs to: tied by research, else by first name; NULL otherwise."""
    address = F.lower(F.coalesce(email, F.lit("")))
    local = F.split(F.substring_index(address, "@", 1), "[._+-]", 2)[0]
    people = F.coalesce(contacts, F.array().cast(CONTACTS))
    tied = F.filter(people, lambda c: F.lower(F.coalesce(c["email"], F.lit(""))) == address)
    named = F.filter(people, lambda c: (
        (F.length(F.substring_index(c["name"], " ", 1)) >= 3)
        & (F.lower(F.substring_index(c["name"], " ", 1)) == local)
    ))
    return F.get(F.concat(tied, named), F.lit(0))


def rank_parts(verified: Column, error: Column, is_role: Column, person: Column) -> tuple[Column, Column]:
    """(confidence rank, kind rank) of an address, lower is better."""
    status = E.deliverability(verified, error)
    confidence = F.when(status == "valid", 0).when(status == "invalid", 2).otherwise(1)
    kind = F.when(person.isNotNull() & F.coalesce(person["is_decision_maker"], F.lit(False)), 0) \
        .when(person.isNull() & F.coalesce(is_role, F.lit(True)), 1).otherwise(2)
    return confidence, kind


def ranked(pool: DataFrame, research: DataFrame) -> DataFrame:
    """Pool rows with their person and rank; ``research`` has one row of contacts per business."""
    rows = pool.join(research.select("business_id", "contacts"), "business_id", "left") \
        .withColumn("_who", person_for(F.col("email"), F.col("contacts")))
    confidence, kind = rank_parts(F.col("verified"), F.col("verification_error"), F.col("is_role"), F.col("_who"))
    return rows.withColumn("conf_rank", confidence).withColumn("kind_rank", kind) \
        .withColumn("person", F.col("_who.name")).drop("_who", "contacts")


def recipients(ranked_pool: DataFrame) -> DataFrame:
    """Best-ranked address per business, the earliest on a tie."""
    order = F.struct("conf_rank", "kind_rank", "pos")
    return ranked_pool.groupBy("business_id").agg(
        F.min_by(F.struct("email", "conf_rank", "kind_rank"), order).alias("_r")
    ).select("business_id", F.col("_r.email").alias("recipient"), F.col("_r.conf_rank").alias("conf_rank"),
             F.col("_r.kind_rank").alias("kind_rank"))


def primary_contact(contacts: Column) -> Column:
    """First decision maker, else the first person named, else NULL."""
    people = F.coalesce(contacts, F.array().cast(CONTACTS))
    deciding = F.filter(people, lambda c: F.coalesce(c["is_decision_maker"], F.lit(False)))
    return F.get(F.concat(deciding, people), F.lit(0))


def greeting_name(email: Column, contacts: Column) -> Column:
    """Whom to greet: the address's person, else the first decision maker, else nobody."""
    people = F.coalesce(contacts, F.array().cast(CONTACTS))
    deciding = F.get(F.filter(people, lambda c: F.coalesce(c["is_decision_maker"], F.lit(False))), F.lit(0))
    who = F.trim(F.coalesce(person_for(email, contacts), deciding)["name"])
    return F.when(F.coalesce(who, F.lit("")) != "", F.split(who, r"\s+")[0])


def people_line(contacts: Column) -> Column:
    """People as one line: title or none, who decides, address."""
    def one(c: Column) -> Column:
        notes = F.array(
            F.coalesce(F.nullif(c["title"], F.lit("")), F.lit("no title stated")),
            F.when(c["is_decision_maker"], "decides on spending"), F.nullif(c["email"], F.lit("")),
        )
        return F.concat(c["name"], F.lit(" ("), F.concat_ws("; ", notes), F.lit(")"))

    line = F.array_join(F.transform(F.coalesce(contacts, F.array().cast(CONTACTS)), one), ", ")
    return F.when(line != "", line).otherwise("none")


def hold_to_recipient(drafts: DataFrame, ranked_pool: DataFrame) -> DataFrame:
    """Selected addresses held to the best rank; the recipient goes first when no pool address is left.

    ``drafts`` has one row per business with the short array ``selected``.
    Businesses without a pool keep their selection.
    """
    best = recipients(ranked_pool)
    picks = drafts.select("business_id", F.posexplode("selected").alias("_pos", "_sel")) \
        .withColumn("_e", F.lower("_sel"))
    pool = ranked_pool.select(
        "business_id", F.lower("email").alias("_e"), F.struct("conf_rank", "kind_rank").alias("_rank")
    ).groupBy("business_id", "_e").agg(F.min("_rank").alias("_rank"))
    judged = picks.join(pool, ["business_id", "_e"], "left").join(best, "business_id", "left")
    limit = F.struct("conf_rank", "kind_rank")
    fine = F.col("_rank").isNull() | F.col("recipient").isNull() | (F.col("_rank") <= limit)
    kept = judged.groupBy("business_id").agg(
        F.transform(F.array_sort(F.collect_list(F.when(fine, F.struct("_pos", "_sel")))), lambda x: x["_sel"]).alias("_kept"),
        F.max(fine & F.col("_rank").isNotNull()).alias("_any"),
    )
    joined = drafts.join(kept, "business_id", "left").join(best.select("business_id", "recipient"), "business_id", "left")
    base = F.coalesce("_kept", F.array().cast("array<string>"))
    final = F.when(F.col("recipient").isNotNull() & ~F.coalesce("_any", F.lit(False)),
                   F.concat(F.array("recipient"), base)).otherwise(base)
    return joined.withColumn("selected", final).drop("_kept", "_any", "recipient")
