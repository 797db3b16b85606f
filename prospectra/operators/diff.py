"""Differences and distributions: changed rows, settings drift, histograms, missing ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.operators.quantiles import quantiles


def differs(pairs: list[tuple[Column, Column]]) -> Column:
    """True when any pair differs, NULLs compared as values."""
    return reduce(lambda a, b: a | b, [~old.eqNullSafe(new) for old, new in pairs])


def histogram(df: DataFrame, key: str) -> DataFrame:
    """Rows and percent share per value, the total read once as a scalar."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("percent", F.round(F.lit(100.0) * F.col("n") / total, 1))


def distinct_percentiles(df: DataFrame, value: str, points: list[float]) -> DataFrame:
    """Exact percentiles of a column of any number of distinct values."""
    names = [f"p{round(p * 100)}" for p in points]
    found = quantiles(df, [], value, points)
    return found.select(*[F.col(f"q{i}").alias(n) for i, n in enumerate(names)])


def share_at_or_above(df: DataFrame, value: str, cutoffs: list[int]) -> DataFrame:
    """Percent of rows at or above each cutoff."""
    return df.agg(*[
        F.round(F.lit(100.0) * F.count_if(F.col(value) >= c) / F.count(F.lit(1)), 1).alias(f"ge_{c}")
        for c in cutoffs
    ])


def settings_drift(current: DataFrame, desired: dict[str, Column], keys: list[str]) -> DataFrame:
    """Rows whose settings differ, with the changes and the values they replace as text maps."""
    def pairs(values: dict[str, Column]) -> Column:
        return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v.cast("string"))])

    changed = {
        k: ~F.col(k).cast("string").eqNullSafe(v.cast("string")) for k, v in desired.items()
    }
    flags = F.create_map(*[x for k, c in changed.items() for x in (F.lit(k), c)])
    wanted = F.map_filter(pairs(desired), lambda k, _: F.element_at(flags, k))
    before = F.map_filter(
        pairs({k: F.col(k) for k in desired}), lambda k, _: F.element_at(flags, k)
    )
    return current.select(*keys, wanted.alias("changes"), before.alias("previous")) \
        .filter(F.size("changes") > 0)


def listed_only(df: DataFrame, column: str, only: list[str] | None, exclude: list[str] | None) -> DataFrame:
    """Rows on the allow list (all when empty) and not on the deny list, case-blind."""
    low = F.lower(F.col(column))
    if only:
        df = df.filter(low.isin(*[x.lower() for x in only]))
    if exclude:
        df = df.filter(~low.isin(*[x.lower() for x in exclude]))
    return df


def not_found(requested: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Requested keys nothing was found for."""
    return requested.select(key).distinct().join(found, key, "left_anti")
