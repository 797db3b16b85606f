"""Stored answers of a page-reader service, and the links they list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from prospectra.functions.text import content_error, strip_controls


def parse(responses: DataFrame, raw: str = "raw", longest_error: int | None = None) -> DataFrame:
    """Text, status, final URL and error of each raw answer.

    Three shapes occur: a page, an error envelope, and something that is not JSON.
    The site's own status wins over the service's code. ``longest_error`` cuts the message.
    """
    v = F.try_parse_json(F.col(raw))
    df = responses.withColumn("_v", v)
    data = F.try_variant_get("_v", "$.data.content", "string")
    is_page = F.schema_of_variant(F.try_variant_get("_v", "$.data", "variant")).startswith("OBJECT")
    code = F.try_variant_get("_v", "$.code", "int")
    status = F.try_variant_get("_v", "$.data.httpStatus", "int")
    content = F.trim(F.coalesce(data, F.lit("")))
    message = F.coalesce(
        F.try_variant_get("_v", "$.message", "string"), F.try_variant_get("_v", "$.name", "string"),
        F.lit("no data in response"),
    )
    page = F.coalesce(is_page, F.lit(False))
    error = (
        F.when(F.col("_v").isNull(), "unparseable response")
        .when(~page, message if longest_error is None else F.left(message, F.lit(longest_error))).otherwise(content_error(content))
    )
    return df.withColumn("fetch_error", strip_controls(error)) \
        .withColumn("text", F.when(F.col("fetch_error").isNull(), strip_controls(content))) \
        .withColumn("http_status", F.when(F.col("_v").isNull(), 0).when(~page, F.coalesce(code, F.lit(0)))
                    .otherwise(F.coalesce(F.nullif(status, F.lit(0)), code, F.lit(0)))) \
        .withColumn("final_url", F.when(page, F.try_variant_get("_v", "$.data.url", "string"))) \
        .withColumn("links", F.when(page, F.try_variant_get("_v", "$.data.links", "map<string,string>"))) \
        .withColumn("tokens", F.when(page, F.try_variant_get("_v", "$.data.usage.tokens", "bigint"))) \
        .drop("_v")


def link_rows(parsed: DataFrame, keys: list[str]) -> DataFrame:
    """One row per link of a successfully read page, blank texts and targets skipped."""
    good = parsed.filter(F.col("text").isNotNull())
    return good.select(*keys, F.explode("links").alias("link_text", "link_href")) \
        .filter((F.coalesce("link_text", F.lit("")) != "") & (F.coalesce("link_href", F.lit("")) != "")) \
        .withColumn("link_text", strip_controls("link_text")) \
        .dropDuplicates([*keys, "link_href"])


def token_usage(parsed: DataFrame) -> DataFrame:
    """Pages read and tokens spent over successes."""
    return parsed.filter(F.col("text").isNotNull()).agg(
        F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")
    )
