"""Derived tables brought up to date from what changed between two versions of their inputs.

Inputs and result are bucket tables. Only buckets that a version in between touched are read
for the change set; the ids of changed rows, old and new, say which entities are affected;
only those are computed anew, and only their buckets of the result are rewritten.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from prospectra.operators.diff import differs
from prospectra.sources.buckets import BucketTable, Manifest
from prospectra.sources.tables import written


def touched_since(table: BucketTable, since: int, until: int | None = None) -> list[int]:
    """Buckets that the versions after ``since`` touched, up to ``until``."""
    last = table.manifest(until).version
    return sorted({b for v in table.versions() if since < v <= last for b in table.manifest(v).touched})


def changes(table: BucketTable, since: int, until: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Keys of rows that differ between two versions with ``change``: insert, update or delete.

    ``carry`` names columns whose old and new values are wanted, as ``old_c`` and ``new_c``.
    Neither version is shuffled: both lie in the same buckets.
    """
    m = table.manifest(until)
    buckets = touched_since(table, since, m.version)
    old, new = table.read(since, buckets), table.read(m.version, buckets)
    names = [c for c in new.columns if c not in m.keys]
    before = old.select(*m.keys, *[F.col(c).alias(f"old_{c}") for c in names], F.lit(True).alias("_old"))
    after = new.select(*m.keys, *[F.col(c).alias(f"new_{c}") for c in names], F.lit(True).alias("_new"))
    both = before.join(after, m.keys, "full_outer")
    changed = differs([(F.col(f"old_{c}"), F.col(f"new_{c}")) for c in names]) if names else F.lit(False)
    kind = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete").when(changed, "update")
    return both.withColumn("change", kind).filter(F.col("change").isNotNull()) \
        .select(*m.keys, "change", *[f"{side}_{c}" for c in carry for side in ("old", "new")])


@dataclass(frozen=True)
class Input:
    """A table a result was made of, the version it was made of, and its column that names the entity."""

    table: BucketTable
    since: int
    entity: str = "id"


def affected(inputs: dict[str, Input], entity: str = "id") -> DataFrame:
    """Entities with a changed row in any input, as ``entity``; a row that moved from one to another affects both."""
    parts = []
    for i in inputs.values():
        if i.entity in i.table.manifest().keys:
            parts.append(changes(i.table, i.since).select(F.col(i.entity).alias(entity)))
        else:
            moved = changes(i.table, i.since, carry=(i.entity,))
            parts.append(moved.select(F.explode(F.array(f"old_{i.entity}", f"new_{i.entity}")).alias(entity)))
    return reduce(DataFrame.unionByName, parts).filter(F.col(entity).isNotNull()).distinct()


def refresh(inputs: dict[str, Input], result: BucketTable, compute: Callable[[dict[str, DataFrame]], DataFrame], path: str, entity: str = "id") -> Manifest:
    """Brings a result keyed by ``entity`` up to date with the inputs' newest versions.

    ``compute`` gets the rows of affected entities by the inputs' names and gives their rows of
    the result; affected entities it gives no row for leave the result. The affected ids are
    written to ``path`` first.
    """
    ids = written(affected(inputs, entity), path)
    rows = {}
    for name, i in inputs.items():
        m = i.table.manifest()
        own = ids.withColumnRenamed(entity, i.entity)
        # By key only the buckets of the affected ids are read; by another column the rows are filtered.
        buckets = BucketTable.buckets_of(own, m) if m.keys == [i.entity] else None
        rows[name] = i.table.read(m.version, buckets).join(own, i.entity, "left_semi")
    fresh = compute(rows)

    def replaced(old: DataFrame) -> DataFrame:
        return old.join(ids, entity, "left_anti").unionByName(fresh.select(*old.columns))

    return result.change(ids, replaced)
