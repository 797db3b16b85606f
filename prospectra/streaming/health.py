"""Health ticks as a stream: a small state per fleet is carried from batch to batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from prospectra.operators.topk import first_k
from prospectra.plans.candidates import is_stale_claim
from prospectra.plans.health import decide


def remembered(ticks: DataFrame, key: str, last: int = 10) -> DataFrame:
    """The ticks a later decision can look at: a fleet's ``last`` newest and the newest good one per action."""
    newest = [F.col("checked_at").desc(), F.col("tick_id").desc()]
    good = first_k(ticks.filter(F.coalesce("action_ok", F.lit(False))), [key, "action"], newest, 1, "_rn")
    return first_k(ticks, [key], newest, last, "_rn").unionByName(good).drop("_rn").distinct()


def decide_stream(
    ticks: DataFrame, log: str, state: str, decisions: str, checkpoint: str, key: str, workers: int,
) -> StreamingQuery:
    """Appends ticks to the log and writes, per batch, the action for every fleet's newest tick.

    A batch reads its own ticks and the state the batch before it wrote, never the
    log, and decides as the batch form does over the whole log (a tick delivered
    twice counts once). A batch that runs again replaces its own folders.
    """
    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        df.write.mode("overwrite").parquet(f"{log}/batch={number}")
        read = spark.read.schema(df.schema)
        known = read.parquet(f"{log}/batch={number}")
        if number:
            known = known.unionByName(read.parquet(f"{state}/batch={number - 1}"))
        remembered(known, key).write.mode("overwrite").parquet(f"{state}/batch={number}")
        held = read.parquet(f"{state}/batch={number}")
        newest = held.agg(F.max("checked_at").alias("m")).scalar()
        decide(held, key, newest, F.lit(workers)).write.mode("overwrite").parquet(f"{decisions}/batch={number}")

    return ticks.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()


def expired_claims(state: DataFrame, now: Column) -> DataFrame:
    """Claims whose run must have died; they may be claimed again."""
    return state.filter(is_stale_claim(F.col("status"), F.col("claimed_at"), now))


def outcome_counters(outcomes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Outcome counts of every micro-batch as rows of a metrics table."""
    def batch(df: DataFrame, number: int) -> None:
        df.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).withColumn("batch_number", F.lit(number)) \
            .write.mode("overwrite").parquet(f"{path}/batch={number}")

    return outcomes.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
