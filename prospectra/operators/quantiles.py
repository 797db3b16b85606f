"""Exact and sketched quantiles of groups of any size.

Exact ones never hold a group's values in one buffer: distinct values with their counts are
dealt to ranges of (group, value), ranges are counted, and the value at a rank is the one
whose counts reach over it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from prospectra.operators.skew import ranged


def rank_ranges(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """``by, value, n, before``: distinct values of a group, how often each stands and how many rows stand before it."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    order = [*[F.col(c).asc_nulls_first() for c in by], F.col(value)]
    rows = ranged(counted, order, "quantile-ranges")
    parts = rows.groupBy(*by, "_part").agg(F.sum("n").alias("_all"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # A row per group, and one more per range that a large group reaches into.
    parts = parts.withColumn("_base", F.coalesce(F.sum("_all").over(earlier), F.lit(0))).drop("_all")
    inside = Window.partitionBy(*by, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in [*by, "_part"]]
    placed = rows.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("_l").join(parts.alias("_r"), same).select("_l.*", "_base")
    return placed.select(*by, value, "n", (F.col("_base") + F.col("_inside")).alias("before"))


def quantiles(df: DataFrame, by: list[str], value: str, points: list[float]) -> DataFrame:
    """Exact quantiles per group, ``q0, q1, ...`` for the given points, between two values in proportion.

    Without ``by`` all rows are one group.
    """
    if not by:
        return quantiles(df.select(F.lit(0).alias("_group"), value), ["_group"], value, points).drop("_group")
    rows = rank_ranges(df, by, value)
    total = rows.groupBy(*by).agg(F.sum("n").alias("_total"))
    same = [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in by]
    known = rows.alias("_l").join(total.alias("_r"), same).select("_l.*", "_total")
    held = lambda rank: (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))
    out, picks = [], []
    for i, p in enumerate(points):
        at = F.lit(float(p)) * (F.col("_total") - 1)
        low, high = F.floor(at), F.ceil(at)
        picks += [F.max(F.when(held(low), F.col(value))).alias(f"_l{i}"), F.max(F.when(held(high), F.col(value))).alias(f"_h{i}"), F.max(at - low).alias(f"_s{i}")]
        out.append((F.col(f"_l{i}") + (F.col(f"_h{i}") - F.col(f"_l{i}")) * F.col(f"_s{i}")).alias(f"q{i}"))
    return known.groupBy(*by).agg(*picks).select(*by, *out)


def sketched_quantiles(df: DataFrame, by: list[str], value: str, points: list[float], size: int = 1000) -> DataFrame:
    """Quantiles per group from a mergeable sketch: one pass, partial sketches of bounded size.

    A point's true rank is within about ``1.7 / size ** 0.9`` of all rows, the normalised error of
    a sketch of that size.
    """
    held = df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size)).alias("_k"))
    return held.select(*by, *[F.kll_sketch_get_quantile_double("_k", F.lit(float(p))).alias(f"q{i}") for i, p in enumerate(points)])
