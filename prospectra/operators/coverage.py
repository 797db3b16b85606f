"""Search coverage: grids with zeros, pending work, planned minus done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.operators.topk import cap_groups


def _listed(values: list[str]) -> Column:
    """A vocabulary as an array that sits in the plan."""
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def name_grid(targets: DataFrame, target: str, names: list[str], name: str) -> DataFrame:
    """Every target with every listed name, without a join."""
    return targets.select(target).distinct().withColumn(name, F.explode(_listed(names)))


def grid_counts(log: DataFrame, target: str, category: str, categories: list[str]) -> DataFrame:
    """Rows per (target, category), zeros included."""
    counted = log.groupBy(target, category).agg(F.count(F.lit(1)).alias("n"))
    return name_grid(log, target, categories, category).join(counted, [target, category], "left") \
        .select(target, category, F.coalesce("n", F.lit(0)).alias("record_count"))


def names_within(text: Column, names: list[str]) -> Column:
    """The listed names a text contains. The list sits in the plan, so nothing is joined."""
    return F.filter(_listed(names), lambda n: F.contains(text, n))


def metro_counts(spark, log: DataFrame, geo: str, category: str, metros: list[str], services: list[str]) -> DataFrame:
    """Log rows per (metro, service) with the metro's name inside the geo target, zeros included."""
    counted = (
        log.select(F.explode(names_within(F.col(geo), metros)).alias("metro"), F.col(category).alias("service"))
        .groupBy("metro", "service").agg(F.count(F.lit(1)).alias("n"))
    )
    grid = spark.range(1).select(F.explode(_listed(metros)).alias("metro")) \
        .select("metro", F.explode(_listed(services)).alias("service"))
    return grid.join(counted, ["metro", "service"], "left").select(
        "metro", "service", F.coalesce("n", F.lit(0)).alias("record_count")
    )


def metro_crosstab(counts: DataFrame, services: list[str]) -> DataFrame:
    """One row per metro, one column per service."""
    return counts.groupBy("metro").pivot("service", services).agg(F.sum("record_count"))


def pending(counts: DataFrame, force: bool = False) -> DataFrame:
    """(metro, service) pairs still to run; all of them when forced."""
    return counts if force else counts.filter(F.col("record_count") == 0)


def geo_plan(metros: DataFrame) -> DataFrame:
    """Metro -> its core city and suburbs, in file order."""
    geos = F.concat(F.array("core_city"), F.col("suburbs"))
    return metros.select("metro", "metro_pos", F.posexplode(geos).alias("geo_pos", "geo_target")) \
        .withColumn("position", F.struct("metro_pos", "geo_pos"))


def plan_searches(
    geos: DataFrame, terms: list[str], log: DataFrame, service: str, phase: str,
    max_geo: int | None = None, force: bool = False,
) -> DataFrame:
    """``<term> in <geo>`` searches not run before, optionally for the first ``max_geo`` geos.

    A geo counts against the cap only once it contributes work. Log rows without
    a query say nothing about single terms and are ignored.
    """
    wanted = geos.select(
        "geo_target", "position", F.posexplode(_listed(terms)).alias("term_pos", "term")
    ).withColumn("keyword", F.concat_ws(" in ", "term", "geo_target"))
    if not force:
        done = log.filter((F.col("service_category") == service) & F.col("query").isNotNull())
        wanted = wanted.join(done.select(F.col("query").alias("keyword")), "keyword", "left_anti")
    if max_geo is not None:
        wanted = cap_groups(wanted, "geo_target", "position", max_geo)
    return wanted.select(
        "keyword", "geo_target", F.lit(service).alias("service_category"),
        F.lit(phase).alias("phase"), "position", "term_pos",
    )


def stage_completion(eligible: DataFrame, done: dict[str, DataFrame], key: str) -> DataFrame:
    """Per stage: how many eligible keys, how many done, the share."""
    stages = None
    for name, df in done.items():
        hit = df.select(key).distinct().withColumn("_done", F.lit(1))
        row = eligible.select(key).join(hit, key, "left").agg(
            F.lit(name).alias("stage"), F.count(F.lit(1)).alias("eligible"),
            F.count("_done").alias("done"),
        )
        stages = row if stages is None else stages.unionByName(row)
    share = F.round(F.lit(100.0) * F.col("done") / F.col("eligible"), 1)
    return stages.withColumn("percent", F.when(F.col("eligible") > 0, share))
