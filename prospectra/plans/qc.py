"""Quality checks on the master: state codes, duplicate candidates for review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.operators.merge import insert_absent
from prospectra.plans.scoring import lookup

# The states the covered metros lie in.
STATE_CODES = {
    "arizona": "AZ", "california": "CA", "colorado": "CO", "connecticut": "CT",
    "district of columbia": "DC", "florida": "FL", "georgia": "GA", "illinois": "IL",
    "maryland": "MD", "massachusetts": "MA", "new jersey": "NJ", "new york": "NY",
    "pennsylvania": "PA", "texas": "TX", "virginia": "VA", "washington": "WA",
}


def state_code(state: Column, codes: dict[str, str] = STATE_CODES) -> Column:
    """Two-letter code of a spelled-out or coded state; NULL when unknown."""
    s = F.trim(state)
    return F.when(F.upper(s).isin(*codes.values()) & (F.length(s) == 2), F.upper(s)).otherwise(lookup(codes, F.lower(s)))


def state_of_geo(geo: Column, codes: dict[str, str] = STATE_CODES) -> Column:
    """State from the ``, ST`` ending of a search geo."""
    code = F.regexp_extract(geo, r",\s*([A-Z]{2})\s*$", 1)
    return F.when(code.isin(*codes.values()), code)


def normalise_states(businesses: DataFrame, codes: dict[str, str] = STATE_CODES) -> DataFrame:
    """State and where it came from. Unknown spellings stay as they are; a missing state is inferred."""
    has = F.coalesce(F.trim("state"), F.lit("")) != ""
    code, inferred = state_code(F.col("state"), codes), state_of_geo(F.col("geo_target"), codes)
    source = F.when(has, F.coalesce("state_source", F.lit("scraped"))) \
        .when(inferred.isNotNull(), "inferred_from_geo_target").otherwise(F.col("state_source"))
    outcome = F.when(has & code.isNull(), "unresolved").when(has & (code == F.trim("state")), "already_ok") \
        .when(has, "normalized").when(inferred.isNotNull(), "inferred").otherwise("unresolved")
    return businesses.withColumn("_state", F.when(has, F.coalesce(code, F.col("state"))).otherwise(inferred)) \
        .withColumn("state_outcome", outcome).withColumn("state_source", source) \
        .drop("state").withColumnRenamed("_state", "state")


def duplicate_candidates(businesses: DataFrame) -> DataFrame:
    """One flag per name key held by several rows: never merged, only put up for review.

    Corroborated means all stated domains, or all stated phones, agree and more
    than one row states one. The members' fingerprint stands for the sorted id
    list, so a flag keeps its identity however large the group is.
    """
    def agree(c: str) -> Column:
        return (F.min(c) == F.max(c)) & (F.count(c) > 1)

    groups = businesses.filter(F.col("name_city_state_key").isNotNull()).groupBy("name_city_state_key").agg(
        F.count(F.lit(1)).alias("members"), agree("domain").alias("_d"), agree("phone_normalized").alias("_p"),
        (F.min("domain") == F.max("domain")).alias("_one_domain"),
        F.min("id").alias("first_id"), F.max("id").alias("last_id"),
        F.bit_xor(F.xxhash64("id")).alias("fingerprint"),
    ).filter(F.col("members") > 1)
    shared_domain = F.coalesce("_d", F.lit(False))
    corroborated = shared_domain | F.coalesce("_p", F.lit(False))
    reason = F.when(
        corroborated, F.when(F.coalesce("_one_domain", F.lit(False)), "same name+city, shared domain")
        .otherwise("same name+city, shared phone")
    ).otherwise("same name+city, no shared domain or phone")
    return groups.select(
        F.lit("dup_candidate").alias("kind"), "name_city_state_key", reason.alias("reason"),
        corroborated.alias("corroborated"), "members", "first_id", "last_id", "fingerprint",
    )


def duplicate_members(businesses: DataFrame, flags: DataFrame) -> DataFrame:
    """The rows behind the flags, one per member."""
    return businesses.join(flags.select("name_city_state_key"), "name_city_state_key", "left_semi")


def open_reviews(stored: DataFrame, flags: DataFrame) -> DataFrame:
    """Review queue with new flags added; a finding already open is not repeated."""
    return insert_absent(stored, flags, ["kind", "name_city_state_key", "fingerprint"])
