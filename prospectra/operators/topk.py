"""Arg-max with explicit ties, budgets, first k per group, trailing streaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def budget(df: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """The best ``limit`` rows; give ``order`` a unique tie-break."""
    return df.orderBy(*order).limit(limit)


def first_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of every group with their rank."""
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.filter(F.col(rank) <= k)


def best_or_none(df: DataFrame, keys: list[str], score: str, value: str) -> DataFrame:
    """The value with the top score per key, NULL when several rows share that score."""
    tied = df.groupBy(*keys, score).agg(F.min(value).alias(value), F.count(F.lit(1)).alias("_n"))
    top = tied.groupBy(*keys).agg(
        F.max(score).alias(score), F.max_by(F.struct(value, "_n"), score).alias("_t")
    )
    return top.select(
        *keys, score,
        F.when(F.col("_t._n") == 1, F.col(f"_t.{value}")).alias(value),
        F.col("_t._n").alias("tied"),
    )


def latest(df: DataFrame, keys: list[str], at: str, values: list[str], tie: str | None = None) -> DataFrame:
    """Values of the newest row per key."""
    order = F.struct(F.col(at), *([F.col(tie)] if tie else []))
    picked = F.max_by(F.struct(*values), order)
    return df.groupBy(*keys).agg(picked.alias("_v")).select(*keys, "_v.*")


def cap_groups(work: DataFrame, group: str, position: str, max_groups: int) -> DataFrame:
    """Work of the first ``max_groups`` groups in plan order: a cap on groups, not on rows."""
    chosen = (
        work.groupBy(group).agg(F.min(position).alias("_first"))
        .orderBy("_first", group).limit(max_groups)
    )
    return work.join(chosen.select(group), group, "left_semi")


def trailing_streak(
    ticks: DataFrame, keys: list[str], at: str, verdict: str, tie: str,
    current: Column | None = None, last: int = 10,
) -> DataFrame:
    """How many of the newest ticks in a row carry the current verdict (at most ``last``).

    ``current`` defaults to the newest tick's verdict.
    """
    recent = first_k(ticks, keys, [F.col(at).desc(), F.col(tie).desc()], last, "_rn")
    newest = F.max_by(F.col(verdict), -F.col("_rn"))
    packed = recent.groupBy(*keys).agg(
        newest.alias("_newest"),
        F.array_sort(F.collect_list(F.struct("_rn", verdict))).alias("_ticks"),
    )
    wanted = F.col("_newest") if current is None else current
    others = F.filter(F.col("_ticks"), lambda t: ~t[verdict].eqNullSafe(wanted))
    first_other = F.coalesce(F.get(others, F.lit(0))["_rn"], F.size("_ticks") + 1)
    return packed.select(*keys, wanted.alias(verdict), (first_other - 1).alias("streak"))


def minutes_since(df: DataFrame, keys: list[str], at: str, succeeded: Column, now: Column, never: int = 99999) -> DataFrame:
    """Whole minutes since the last row that satisfies ``succeeded``; a sentinel when none does."""
    last_at = F.max(F.when(succeeded, F.col(at).cast("timestamp")))
    minutes = F.round((F.unix_micros(now) - F.unix_micros(last_at)) / 60e6).cast("long")
    return df.groupBy(*keys).agg(F.coalesce(minutes, F.lit(never)).alias("minutes"))


def running_streak(df: DataFrame, key: str, seq: str, flag: str, chunk: int = 100_000) -> DataFrame:
    """Adds ``position`` and ``streak``: how many rows in a row, up to this one, carry the flag.

    Each key is cut into ranges of ``seq``. A range is numbered on its own; only
    its length and its last unflagged row are carried over to the ranges after
    it, so one very long key is spread over many tasks.
    """
    cut = df.withColumn("_chunk", F.floor(F.col(seq) / chunk))
    own = Window.partitionBy(key, "_chunk").orderBy(seq)
    cut = cut.withColumn("_n", F.row_number().over(own))
    off = F.when(~F.col(flag), F.col("_n"))
    cut = cut.withColumn("_off", F.max(off).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    sizes = df.withColumn("_chunk", F.floor(F.col(seq) / chunk)).groupBy(key, "_chunk").agg(
        F.count(F.lit(1)).alias("_size")
    )
    last_off = cut.groupBy(key, "_chunk").agg(F.max("_off").alias("_last"))
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = sizes.join(last_off, [key, "_chunk"]) \
        .withColumn("_base", F.coalesce(F.sum("_size").over(earlier), F.lit(0))) \
        .withColumn("_prev", F.coalesce(F.max(F.col("_base") + F.col("_last")).over(earlier), F.lit(0))) \
        .select(key, "_chunk", "_base", "_prev")
    joined = cut.join(carried, [key, "_chunk"])
    position = F.col("_base") + F.col("_n")
    since = F.coalesce(F.col("_base") + F.col("_off"), F.col("_prev"))
    return joined.withColumn("position", position) \
        .withColumn("streak", F.when(F.col(flag), F.col("position") - since).otherwise(0)) \
        .drop("_chunk", "_n", "_off", "_base", "_prev")
