"""Ad evidence: stored responses decoded, kept per domain, rolled up to every holder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.functions.identity import host
from prospectra.functions.reviews import LATEST_EPOCH, epoch_seconds, is_stale, within_days
from prospectra.operators.match import fan_out
from prospectra.operators.merge import merge_upsert
from prospectra.operators.stage import staged
from prospectra.operators.topk import running_streak

PAGE_SIZE = 40
# Field numbers of a stored response.
RESPONSE = (
    "struct<`1`:array<struct<`1`:string,`2`:string,"
    "`3`:struct<`3`:struct<`2`:string>,`1`:struct<`4`:string>>,"
    "`4`:string,`6`:struct<`1`:string>,`7`:struct<`1`:string>,`12`:string,`14`:string>>,`2`:string>"
)
# Hosts whose ads are not the business's own.
NOT_OWN_SITE = r"(?i)(?:facebook\.com|instagram\.com|nextdoor\.com|linktr\.ee|yelp\.com|google\.com)"


def _first(values: Column) -> Column:
    return F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0))


def decode(responses: DataFrame, body: str = "body", latest: int = LATEST_EPOCH) -> DataFrame:
    """Creatives, advertiser, date range and formats of each response; ``{}`` means no ads.

    A date after ``latest`` (epoch seconds) counts as absent.
    """
    df = responses.withColumn("_r", F.from_json(F.col(body), RESPONSE))
    ads = F.filter(F.coalesce(F.col("_r")["1"], F.array().cast(
        "array<struct<`1`:string,`2`:string,`3`:struct<`3`:struct<`2`:string>,`1`:struct<`4`:string>>,"
        "`4`:string,`6`:struct<`1`:string>,`7`:struct<`1`:string>,`12`:string,`14`:string>>"
    )), lambda a: a.isNotNull())

    def creative(a: Column) -> Column:
        markup = a["3"]["3"]["2"]
        src = F.regexp_extract(markup, r'(?i)src\s*=\s*"([^"]+)"', 1)
        wide = F.regexp_extract(markup, r'(?i)width\s*=\s*"(\d+)"', 1)
        high = F.regexp_extract(markup, r'(?i)height\s*=\s*"(\d+)"', 1)
        return F.struct(
            a["2"].alias("creative_id"), a["4"].alias("format"),
            epoch_seconds(a["6"]["1"], latest).alias("first_shown"), epoch_seconds(a["7"]["1"], latest).alias("last_shown"),
            F.when(markup != "", markup).alias("markup"), F.when(src != "", src).alias("image_url"),
            F.when((wide != "") & (high != ""), F.concat_ws("x", wide, high)).alias("dimensions"),
            F.when(a["3"]["1"]["4"] != "", a["3"]["1"]["4"]).alias("preview_url"),
        )

    df = staged(df, {"_ads": ads})
    df = staged(df, {"creatives": F.transform("_ads", creative)})
    n = F.size("creatives")
    return df.select(
        *responses.columns, (n > 0).alias("found"),
        _first(F.transform("_ads", lambda a: a["1"])).alias("advertiser_id"),
        _first(F.transform("_ads", lambda a: a["12"])).alias("advertiser_name"),
        n.alias("creative_count"),
        F.array_min(F.transform("creatives", lambda c: c["first_shown"])).alias("first_shown"),
        F.array_max(F.transform("creatives", lambda c: c["last_shown"])).alias("last_shown"),
        F.array_sort(F.array_distinct(F.filter(
            F.transform("_ads", lambda a: a["4"]), lambda f: f.isNotNull()
        ))).alias("formats"),
        "creatives",
        ((n >= PAGE_SIZE) & (F.coalesce(F.col("_r")["2"], F.lit("")) != "")).alias("truncated"),
    )


def fold_creatives(creatives: DataFrame, key: str, now: Column) -> DataFrame:
    """The same fold over a long table of creatives, one row per ad."""
    return creatives.groupBy(key).agg(
        F.count(F.lit(1)).alias("creative_count"), F.min("first_shown").alias("first_shown"),
        F.max("last_shown").alias("last_shown"),
        F.array_sort(F.collect_set("format")).alias("formats"),
    ).withColumn("ads_confirmed_active", within_days(F.col("last_shown"), now))


def targets(businesses: DataFrame, evidence: DataFrame, now: Column, stale_days: int | None = None) -> DataFrame:
    """Domains to check once, with the number of holders; good recent evidence excludes a business."""
    good = evidence.filter(F.col("http_status") == 200)
    if stale_days is not None:
        good = good.filter(~is_stale(F.col("checked_at"), now, stale_days))
    eligible = businesses.filter(
        (F.coalesce("website", F.lit("")) != "") & ~F.col("website").rlike(NOT_OWN_SITE)
        & (F.col("qc_status") != "REJECTED")
    ).join(good.select(F.col("business_id").alias("id")), "id", "left_anti")
    return eligible.withColumn("domain", host("website", reject_ip=True)) \
        .filter(F.col("domain").isNotNull()).groupBy("domain").agg(
            F.count(F.lit(1)).alias("holders"), F.max("icp_score").alias("best_score"))


def throttle_cut(probes: DataFrame, limit: int = 12, run: str = "run_id", at: str = "seq") -> DataFrame:
    """Per run: the position at which ``limit`` throttled probes in a row end it, and the counts."""
    marked = running_streak(probes, run, at, "throttled")
    return marked.groupBy(run).agg(
        F.min(F.when(F.col("streak") == limit, F.col("position"))).alias("cut_at"),
        F.max("streak").alias("longest"), F.count_if("throttled").alias("throttled"),
        F.count_if(~F.col("throttled")).alias("answered"),
    )


def store(evidence: DataFrame, answers: DataFrame, holders: DataFrame, now: Column) -> DataFrame:
    """Evidence per (business, domain) after a run.

    Throttled probes asked nothing and are left out; a failed check never replaces
    a good row.
    """
    fanned = fan_out(holders, answers.filter(~F.coalesce("throttled", F.lit(False))).drop("throttled"), "domain") \
        .withColumn("checked_at", now)
    good = evidence.filter(F.col("http_status") == 200).select("business_id", "domain").withColumn("_good", F.lit(True))
    kept = fanned.join(good, ["business_id", "domain"], "left") \
        .filter((F.col("http_status") == 200) | F.col("_good").isNull()).drop("_good")
    return merge_upsert(evidence, kept, ["business_id", "domain"])


def rollup(businesses: DataFrame, evidence: DataFrame, now: Column) -> DataFrame:
    """Entity columns recomputed from good evidence only; unchecked businesses stay unknown."""
    good = evidence.filter(F.col("http_status") == 200)
    newest = good.groupBy(F.col("business_id").alias("id")).agg(
        F.max("last_shown").alias("ads_last_shown"), F.max("creative_count").alias("ads_creative_count"),
    )
    fresh = newest.withColumn("ads_confirmed_active", within_days(F.col("ads_last_shown"), now))
    base = businesses.drop("ads_last_shown", "ads_creative_count", "ads_confirmed_active")
    return base.join(fresh, "id", "left")


def pixel_disagreement(businesses: DataFrame) -> DataFrame:
    """Advertisers without a pixel, and pixels without ads, among checked businesses."""
    ads, pixel = F.col("ads_creative_count") > 0, F.coalesce("marketing_active", F.lit(False))
    return businesses.filter(F.col("ads_creative_count").isNotNull()).agg(
        F.count(F.lit(1)).alias("checked"), F.count_if(ads & ~pixel).alias("ads_without_pixel"),
        F.count_if(~ads & pixel).alias("pixel_without_ads"),
    )
