"""Matches with their positions, from Spark's own regex functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from prospectra.functions.identity import let


HITS = "array<struct<start:int,hit:string>>"


def located(text: Column, pattern: str | Column) -> Column:
    """All matches as ``array<struct<start,hit>>``, ``start`` counted from 1.

    The pieces between the matches come from splitting on the same pattern, so
    positions are running sums of lengths. A text without a match is read once.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    return let(found, lambda hits: F.when(F.size(hits) == 0, F.array().cast(HITS)).otherwise(
        _with_starts(F.split(text, pattern, -1), hits)
    ))


def _with_starts(gaps: Column, hits: Column) -> Column:
    pairs = F.zip_with(
        F.slice(gaps, 1, F.greatest(F.size(hits), F.lit(0))), hits,
        lambda g, h: F.struct((F.length(g) + F.length(h)).alias("step"), h.alias("hit")),
    )
    return let(pairs, lambda p: F.zip_with(
        running_sums(F.transform(p, lambda x: x["step"])), p,
        lambda end, x: F.struct((end - F.length(x["hit"]) + 1).alias("start"), x["hit"].alias("hit")),
    ))


def running_sums(numbers: Column) -> Column:
    """Inclusive running sums of an array: n numbers take log2(n) passes, each adding the sums twice as far back."""
    passes = F.ceil(F.log2(F.greatest(F.size(numbers), F.lit(2)).cast("double"))).cast("int")
    return F.aggregate(
        F.sequence(F.lit(0), passes - 1), numbers,
        lambda sums, k: F.transform(
            sums, lambda x, i: x + F.coalesce(F.get(sums, i - F.call_function("shiftleft", F.lit(1), k)), F.lit(0)),
        ),
    )


def before(text: Column, start: Column, reach: int) -> Column:
    """Up to ``reach`` characters in front of a position."""
    return F.substring(text, F.greatest(start - reach, F.lit(1)), F.least(start - 1, F.lit(reach)))


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, NULL without one."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))
