"""Registered queries: the Spark callable, what it covers, and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from prospectra.catalog.world import oracle


@dataclass(frozen=True)
class Entry:
    """One registered query."""

    name: str
    run: Callable[[SparkSession, str], DataFrame]
    covers: str
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(covers: str, sql: str | None = None, uses: tuple[str, ...] = ()):
    """Registers a query under its function name."""
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if fn.__name__ in ENTRIES:
            raise ValueError(f"{fn.__name__} is registered twice")
        ENTRIES[fn.__name__] = Entry(fn.__name__, fn, covers, oracle(sql, *uses) if sql else None)
        return fn
    return register
