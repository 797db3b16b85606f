"""Claims on entities by runs that overlap: each id is granted once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.operators.merge import merge_upsert
from prospectra.plans.candidates import open_to_claim
from prospectra.sources.buckets import BucketTable

STATE = "business_id long, status string, reason string, run_id string, claimed_at timestamp, finished_at timestamp"


def claim(table: BucketTable, wanted: DataFrame, run_id: str, now: Column, force: bool = False, attempts: int = 5) -> DataFrame:
    """Claims the wanted ids for a run and returns those granted.

    Grant and state are one commit: a run that loses the race decides again on the state the
    other left, so ids that both want go to one of them. Granted rows are found by run and
    claim time in the committed version. Forced claims take everything.
    """
    ids = wanted.select("business_id").filter(F.col("business_id").isNotNull()).distinct()
    count = table.manifest().count

    def taken(state: DataFrame) -> DataFrame:
        current = state.join(ids.repartition(count, "business_id"), "business_id", "right")
        free = F.lit(True) if force else open_to_claim(F.col("status"), F.col("claimed_at"), now)
        fresh = current.filter(free).select(
            "business_id", F.lit("claimed").alias("status"), F.lit(None).cast("string").alias("reason"), F.lit(run_id).alias("run_id"),
            now.alias("claimed_at"), F.lit(None).cast("timestamp").alias("finished_at"))
        return merge_upsert(state, fresh, ["business_id"]).select(*state.columns)

    done = table.change(ids, taken, attempts)
    after = table.read(done.version, done.touched)
    return after.filter((F.col("status") == "claimed") & (F.col("run_id") == run_id) & (F.col("claimed_at") == now)).join(ids, "business_id", "left_semi").select("business_id")
