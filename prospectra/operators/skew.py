"""Joins and groupings that stay whole when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from prospectra.session import new_path


def salted_join(
    big: DataFrame, lookup: DataFrame, on: list[str], how: str = "left",
    hot_keys: int = 64, salts: int = 32, counts: DataFrame | None = None,
) -> DataFrame:
    """Join many rows to a lookup unique on ``on``, spreading the ``hot_keys`` commonest keys.

    Only the hot keys' lookup rows are repeated, so at most ``hot_keys * salts``
    rows are added and the broadcast list never exceeds ``hot_keys`` rows. All
    other keys take the ordinary shuffle; no row is dropped. Rows with a NULL
    key match nothing and are spread as well. ``counts`` (the keys and a column
    ``count``) saves counting them again.
    """
    counted = counts if counts is not None else big.groupBy(*on).count()
    unmatchable = reduce(or_, [F.col(c).isNull() for c in on])
    hot = counted.filter(~unmatchable).orderBy(F.desc("count"), *on).limit(hot_keys).select(*on, F.lit(True).alias("_hot"))
    # A hash of the row, not a random number: a recomputed task must route rows the same way.
    hashed = [c for c, t in big.dtypes if "map" not in t and "variant" not in t]
    row_hash = F.pmod(F.xxhash64(*hashed), F.lit(salts)).cast("int")
    salt = F.when(F.col("_hot") | unmatchable, row_hash).otherwise(0)
    left = big.join(F.broadcast(hot), on, "left").withColumn("_salt", salt).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    right = (
        lookup.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.explode(copies))
        .drop("_hot")
    )
    return left.join(right, on + ["_salt"], how).drop("_salt")


def pack_rows(
    df: DataFrame, keys: list[str], order: list[str], values: list[str], into: str = "items", max_items: int = 10_000,
) -> DataFrame:
    """Rows of a key as sorted arrays of structs: ``chunk`` 0, 1, ... of ``max_items`` each, the last one shorter.

    The chunks of a key in their order are its rows in theirs, however many there are: what lies
    in chunk k comes before what lies in chunk k + 1. A key that fits one chunk is gathered at
    once. Larger keys, also a NULL one, are dealt to ranges of their order, numbered there, and
    cut by number, so no task holds such a key. Rows go by ``order``, then by the other values.
    """
    fields = list(dict.fromkeys([*order, *values]))
    rows = df.select(*keys, *[c for c in fields if c not in keys])
    item = F.array_sort(F.collect_list(F.struct(*fields))).alias(into)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_items).drop("_n")
    if sizes.isEmpty():
        return rows.groupBy(*keys, F.lit(0).cast("long").alias("chunk")).agg(item)
    large = _cut(sizes, "large-keys")  # at most a key per ``max_items`` rows
    same = [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in keys]
    match = lambda how: rows.alias("_l").join(large.alias("_r"), same, how)
    small = match("left_anti").groupBy(*keys, F.lit(0).cast("long").alias("chunk")).agg(item)
    by = [F.col(c).asc_nulls_first() for c in [*keys, *fields]]
    ranges = ranged(match("left_semi"), by, "ranges")
    counts = ranges.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # A row per range, and one more where a range holds the end of one key and the start of the next.
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    inside = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*by))
    on = [*same, F.col("_l._part") == F.col("_r._part")]
    numbered = ranges.withColumn("_at", inside - 1).alias("_l").join(counts.alias("_r"), on).select("_l.*", "_before")
    chunk = F.floor((F.col("_before") + F.col("_at")) / F.lit(max_items)).alias("chunk")
    return small.unionByName(numbered.groupBy(*keys, chunk).agg(item))


def _cut(df: DataFrame, label: str) -> DataFrame:
    """Rows written to the shared folder and read back, so that what is computed from them twice is the same."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranged(df: DataFrame, order: list, label: str) -> DataFrame:
    """The rows in ranges of ``order``, written and read back with the number of their range as ``_part``."""
    return _cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), label)


def first_non_null(value: Column, order: Column) -> Column:
    """The non-NULL value with the smallest order, as an aggregate."""
    return F.min_by(value, F.when(value.isNotNull(), order))
