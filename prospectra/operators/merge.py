"""Keyed merges: upsert with a policy per column, insert-if-absent, latest row per key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

# overwrite     a source row replaces the value, also with NULL
# coalesce_new  a new value wins, NULL never clobbers
# keep_old      only fills a NULL
# append_array  old entries, then the new ones
# union_array   sorted distinct union
POLICIES = ("overwrite", "coalesce_new", "keep_old", "append_array", "union_array")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``; Spark limits each group before the shuffle."""
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def last_per_key(df: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """One row per key, the last in ``sequence``."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in sequence])


def _merged(policy: str, old: Column, new: Column, hit: Column) -> Column:
    if policy == "overwrite":
        return F.when(hit, new).otherwise(old)
    if policy == "coalesce_new":
        return F.coalesce(new, old)
    if policy == "keep_old":
        return F.coalesce(old, new)
    if policy == "append_array":
        return F.when(new.isNull(), old).when(old.isNull(), new).otherwise(F.concat(old, new))
    if policy == "union_array":
        return F.when(new.isNull(), old).when(old.isNull(), F.array_sort(F.array_distinct(new))) \
            .otherwise(F.array_sort(F.array_union(old, new)))
    raise ValueError(f"unknown policy {policy!r}, expected one of {POLICIES}")


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: list[str],
    policies: Mapping[str, str] | None = None, default: str = "overwrite",
    touched: str | None = None, now: Column | None = None, small_source: bool = False,
) -> DataFrame:
    """The target after merging ``source`` into it; both sides must be unique on ``keys``.

    Columns only the target has are kept. ``touched`` names a timestamp set to
    ``now`` on every merged row. The default is one full outer join. With
    ``small_source`` the target is probed instead, which lets Spark broadcast
    the source when it is small enough and leaves the target unshuffled.
    """
    policies = dict(policies or {})
    shared = [c for c in target.columns if c in source.columns and c not in keys]
    added = [c for c in source.columns if c not in target.columns]
    fresh = source.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in shared + added], F.lit(True).alias("_hit")
    )
    hit = F.coalesce(F.col("_hit"), F.lit(False))

    def shaped(joined: DataFrame) -> DataFrame:
        out = [F.col(k) for k in keys]
        for c in target.columns:
            if c in keys:
                continue
            if c == touched:
                merged = F.when(hit, now if now is not None else F.current_timestamp()).otherwise(
                    F.col(c)
                )
            elif c in shared:
                merged = _merged(policies.get(c, default), F.col(c), F.col(f"_new_{c}"), hit)
            else:
                merged = F.col(c)
            out.append(merged.alias(c))
        out += [F.col(f"_new_{c}").alias(c) for c in added]
        return joined.select(*out)

    if not small_source:
        return shaped(target.join(fresh, keys, "full_outer"))
    present = target.select(*keys).join(source.select(*keys), keys, "left_semi")
    absent = fresh.join(present, keys, "left_anti")
    blank = [F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns if c not in keys]
    return shaped(target.join(fresh, keys, "left")).unionByName(
        shaped(absent.select(*keys, *blank, *[c for c in absent.columns if c not in keys]))
    )


def insert_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus the source rows whose key it lacks; existing rows stay as they are."""
    new = source.join(target.select(*keys), keys, "left_anti").dropDuplicates(keys)
    return target.unionByName(new, allowMissingColumns=True)


def append_source_once(sources: Column, entry: Column, marker: Column) -> Column:
    """Provenance array with ``entry`` appended unless an entry of the same source is there."""
    known = F.exists(sources, lambda s: s["source"] == marker)
    return F.when(sources.isNull(), F.array(entry)).when(known, sources).otherwise(
        F.concat(sources, F.array(entry))
    )


def restore_values(current: DataFrame, saved: DataFrame, keys: list[str]) -> DataFrame:
    """Saved columns put back on the rows that are still present."""
    return merge_upsert(current, saved.join(current.select(*keys), keys, "left_semi"), keys)
