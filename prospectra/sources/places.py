"""Place batches: JSON arrays per search, tagged with the search's metadata, as staging rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from prospectra.functions.identity import file_slug, host, name_key, none_if_blank, phone_key
from prospectra.plans.scoring import about_options, score
from prospectra.schemas import PLACE
from prospectra.sources.array_files import ArrayFiles


def read_places(spark: SparkSession, folder: str, suffix: str = ".json") -> tuple[DataFrame, DataFrame]:
    """(places of all readable files of a folder, one row per bad file with its error).

    A file that is cut off, no JSON or no array gives no places, and an element that is no object
    counts as a bad one of its file.
    """
    spark.dataSource.register(ArrayFiles)
    raw = spark.read.format("array_files").option("suffix", suffix).load(folder)
    stem = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.json$", "")
    read = raw.withColumn("file_stem", stem).withColumn("_p", F.from_json("element", PLACE, {"columnNameOfCorruptRecord": "_corrupt"}))
    broken = F.col("error").isNotNull() | F.col("_p").isNull() | F.col("_p._corrupt").isNotNull()
    fields = [f.name for f in read.schema["_p"].dataType if f.name != "_corrupt"]
    bad = read.filter(broken).select("file", "file_stem", "position", F.coalesce("error", F.lit("element is not a place")).alias("error"))
    return read.filter(~broken).select(*[F.col(f"_p.{f}").alias(f) for f in fields], "file", "file_stem"), bad


def tag_files(places: DataFrame, meta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Places with their search's metadata, and the files no search claims.

    A file is named ``<job>-<slug>``; every suffix that starts after a dash is a
    candidate slug, so the join stays an equality and the longest slug wins.
    """
    files = places.select("file_stem").distinct()
    parts = F.split("file_stem", "-")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "-"),
    )
    slugs = meta.withColumn("slug", file_slug("keyword")).dropDuplicates(["slug"])
    claimed = files.select("file_stem", F.explode(suffixes).alias("slug")).join(slugs, "slug") \
        .groupBy("file_stem").agg(F.max_by(
            F.struct("keyword", "geo_target", F.col("service_category").alias("batch_service"), "phase"),
            F.length("slug"),
        ).alias("_m")).select("file_stem", "_m.*")
    return places.join(claimed, "file_stem"), files.join(claimed, "file_stem", "left_anti")


def staging_rows(tagged: DataFrame) -> DataFrame:
    """Staging rows: normalised identity, flattened address, categories, score of the own text."""
    categories = F.when(F.col("categories").isNotNull(), F.col("categories")) \
        .when(F.col("category").isNotNull(), F.array("category")) \
        .otherwise(F.array().cast("array<string>"))
    a = "complete_address"
    shaped = tagged.select(
        none_if_blank(F.col("place_id")).alias("place_id"),
        host("web_site", require_dot=False).alias("domain"), phone_key("phone").alias("phone_normalized"),
        name_key("title", f"{a}.city", f"{a}.state").alias("name_city_state_key"),
        none_if_blank(F.col("title")).alias("name"), none_if_blank(F.col("link")).alias("maps_url"),
        none_if_blank(F.col("web_site")).alias("website"), none_if_blank(F.col("phone")).alias("phone"),
        none_if_blank(F.col("address")).alias("address"), F.col(f"{a}.city").alias("city"),
        F.col(f"{a}.state").alias("state"), F.col(f"{a}.postal_code").alias("zip"),
        "latitude", "longitude", F.col("review_rating").alias("rating"), "review_count",
        none_if_blank(F.col("category")).alias("primary_category"), categories.alias("categories"),
        none_if_blank(F.col("description")).alias("description"),
        F.when(F.col("open_hours").isNotNull(), F.to_json("open_hours")).alias("hours"),
        none_if_blank(F.col("price_range")).alias("price_range"), none_if_blank(F.col("status")).alias("status"),
        about_options(F.col("about")).alias("about"), "keyword", "geo_target", "batch_service", "phase",
        F.to_json("user_reviews").alias("user_reviews_json"),
    )
    return score(shaped).withColumn(
        "service_category", F.coalesce("derived_service", "batch_service")
    ).withColumnRenamed("keyword", "query").drop("derived_service", "batch_service", "signals")


def write_staging_csv(staging: DataFrame, path: str) -> None:
    """Staging as CSV: header, standard quoting, NULL as empty, arrays pipe-delimited."""
    flat = staging.withColumn("categories", F.array_join("categories", "|")).drop("about")
    flat.write.option("header", True).option("escape", '"').option("nullValue", "").mode("errorifexists").csv(path)


def read_staging_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Typed staging load; the delimited categories become an array again."""
    raw = spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    return raw.withColumn("categories", F.split("categories", r"\|"))


def read_lookup(spark: SparkSession, metros_path: str, terms_path: str) -> tuple[DataFrame, DataFrame]:
    """Metros with position and suburbs, and (service, term) rows, from the two nested files."""
    metros = spark.read.option("multiLine", True).json(metros_path) \
        .select(F.posexplode("metros").alias("metro_pos", "m")).select("metro_pos", "m.metro", "m.core_city", "m.suburbs")
    raw = spark.read.text(terms_path, wholetext=True)
    terms = raw.select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("service", "terms")) \
        .select("service", F.posexplode("terms").alias("term_pos", "term"))
    return metros, terms


def write_searches(plan: DataFrame, text_path: str, meta_path: str) -> None:
    """The planned searches as text, one per line, and their metadata as JSON."""
    plan.select("keyword").write.mode("errorifexists").text(text_path)
    plan.select("keyword", "geo_target", "service_category", "phase").write.mode("errorifexists").json(meta_path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed non-blank lines."""
    return spark.read.text(path).select(F.trim("value").alias("line")).filter(F.col("line") != "")
