"""Counts beside rows: taken by the pass that makes the rows, not by a second one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery


def observed(df: DataFrame, counts: dict[str, Column], name: str = "counts") -> tuple[DataFrame, Observation]:
    """The rows, and how many of them meet each condition once an action has gone through them."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counts.items()]), seen


def observed_stream(df: DataFrame, counts: dict[str, Column], name: str = "counts") -> DataFrame:
    """A stream that counts its rows by condition; ``batch_counts`` reads what it counted."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counts.items()])


def batch_counts(query: StreamingQuery, name: str = "counts") -> list[dict]:
    """The counts of each micro-batch of a query that had rows."""
    out = []
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(name)
        if row is not None and row["rows"]:
            out.append({"batch": progress.batchId, **row.asDict()})
    return out
