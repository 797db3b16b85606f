"""Computed columns that later filters do not drag apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def staged(df: DataFrame, columns: dict[str, Column], drop: tuple[str, ...] = ()) -> DataFrame:
    """Adds columns through a one-row generator, so each is computed once per row.

    A filter on an ordinary computed column is pushed below it with the
    expression copied in. Over several steps with many mentions that multiplies
    regexes; behind a generator the filter sees a plain attribute.
    """
    kept = [c for c in df.columns if c not in columns and c not in drop]
    one = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    return df.select(*kept, F.inline(one))
