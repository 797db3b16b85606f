"""Entity resolution by a waterfall of keys, and answers fanned out to every holder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.operators.skew import salted_join


def _stacked(df: DataFrame, keep: list[str], keys: list[str], first_only: bool) -> DataFrame:
    """One row per non-NULL key of each row: ``key_rank``, ``key_value``."""
    pairs = F.filter(
        F.array(*[
            F.struct(F.lit(i + 1).alias("key_rank"), F.col(k).cast("string").alias("key_value"))
            for i, k in enumerate(keys)
        ]),
        lambda p: p["key_value"].isNotNull(),
    )
    if first_only:
        pairs = F.slice(pairs, 1, 1)
    return df.select(*keep, F.explode(pairs).alias("_p")).select(
        *keep, "_p.key_rank", "_p.key_value"
    )


def waterfall_match(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, keys: list[str],
    prefer: list[Column] | None = None, fallback: str = "if_unmatched", hot_keys: int = 64,
) -> DataFrame:
    """Best match of every left row: ``matched_id``, ``key_rank``, ``candidates``.

    Keys are tried in order and the first hit wins. ``fallback='if_null'`` goes to
    the next key only when the earlier one is NULL. Right rows sharing a key
    are reduced to the one smallest in ``prefer`` (then by id) before the join, so
    shared domains never multiply rows; ``candidates`` says how many there
    were. ``hot_keys`` of the commonest key values are salted (0: none). Rows without
    any key stay out of the join and come back unmatched.
    """
    if fallback not in ("if_unmatched", "if_null"):
        raise ValueError(f"unknown fallback {fallback!r}")
    order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(prefer or [])], F.col(right_id).alias("id"))
    one_per_key = (
        _stacked(right.withColumn("_order", order), ["_order"], keys, False)
        .groupBy("key_rank", "key_value")
        .agg(F.min("_order")["id"].alias("matched_id"), F.count(F.lit(1)).alias("candidates"))
    )
    stacked = _stacked(left, [left_id], keys, fallback == "if_null")
    on = ["key_rank", "key_value"]
    hits = (
        salted_join(stacked, one_per_key, on, "inner", hot_keys)
        if hot_keys else stacked.join(one_per_key, on)
    )
    # Every left row once more, without a match: no second join brings the unmatched back.
    hits = hits.select(left_id, "key_rank", "matched_id", "candidates").unionByName(left.select(left_id), allowMissingColumns=True)
    found = F.struct("key_rank", "matched_id", "candidates")
    best = F.min(F.when(F.col("matched_id").isNotNull(), found))
    return hits.groupBy(left_id).agg(best.alias("_b")).select(
        left_id, F.col("_b.matched_id").alias("matched_id"),
        F.col("_b.key_rank").alias("key_rank"), F.col("_b.candidates").alias("candidates"),
    )


def probe_keys(holders: DataFrame, key: str) -> DataFrame:
    """Distinct keys to ask about once."""
    return holders.select(key).filter(F.col(key).isNotNull()).distinct()


def fan_out(holders: DataFrame, answers: DataFrame, key: str, hot_keys: int = 64) -> DataFrame:
    """Every holder whose key was answered; an unanswered key gives no row, never a negative.

    ``answers`` is unique on ``key``; ``hot_keys`` of the commonest keys are salted (0: none).
    """
    if hot_keys:
        return salted_join(holders, answers, [key], "inner", hot_keys)
    return holders.join(answers, key, "inner")


def find_or_create(wanted: DataFrame, existing: DataFrame, name: str, row_id: str) -> DataFrame:
    """Wanted rows with the id of the existing row of the same name, and the action to take."""
    known = existing.groupBy(name).agg(F.min(row_id).alias(row_id))
    action = F.when(F.col(row_id).isNull(), "create").otherwise("reuse")
    return wanted.join(known, name, "left").withColumn("action", action)
