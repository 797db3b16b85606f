"""Fleet health: queue metrics, verdict, and the action the policy allows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from prospectra.operators.topk import first_k, minutes_since, trailing_streak

REQUIRED_TICKS = 3
# Verdict -> (action, cooldown in minutes).
ACTIONS = {
    "PROXY_DEGRADED": ("proxy_refresh", 30), "WEDGED": ("restart", 15),
    "STALLED": ("restart", 15), "WORKER_DEGRADED": ("restart", 15),
}


def queue_metrics(jobs: DataFrame, results: DataFrame, now: Column, key: str, oldest_running: bool = True) -> DataFrame:
    """Backlog, last progress, running age, zero-yield share of the last ten, recent time-outs per fleet.

    Running age is that of the oldest running job; ``oldest_running=False`` takes the youngest.
    """
    waiting = F.col("state").isin("available", "scheduled") & (F.col("scheduled_at") <= now)
    attempted = F.when(F.col("state") == "running", F.col("attempted_at"))
    started = F.min(attempted) if oldest_running else F.max(attempted)
    timed_out = (F.col("state") == "discarded") & (F.col("finalized_at") > now - F.make_dt_interval(mins=F.lit(20))) \
        & F.contains(F.coalesce("errors", F.lit("")), F.lit("job timed out with no results"))
    queue = jobs.groupBy(key).agg(
        F.count_if(waiting).alias("backlog"), F.max("finalized_at").alias("_finalized"),
        started.alias("_started"), F.count_if(timed_out).alias("recent_timeouts"),
    )
    last = first_k(results, [key], [F.col("created_at").desc(), F.col("result_id").desc()], 10, "_rn")
    yields = last.groupBy(key).agg(
        (F.count_if(F.col("result_count") == 0) / F.lit(10.0)).alias("zero_yield_ratio"),
        F.max("created_at").alias("_created"),
    )
    age = (F.unix_micros(now) - F.unix_micros("_started")) / F.lit(1e6)
    return queue.join(yields, key, "left").select(
        key, "backlog", F.coalesce(F.greatest("_finalized", "_created"), now).alias("last_progress"),
        F.coalesce(F.floor(age), F.lit(0)).alias("longest_running_sec"),
        F.coalesce("zero_yield_ratio", F.lit(0.0)).alias("zero_yield_ratio"), "recent_timeouts",
    )


def host_states(probes: DataFrame, key: str) -> DataFrame:
    """Worker hosts per fleet and how many of them do not serve."""
    return probes.groupBy(key).agg(
        F.count(F.lit(1)).alias("workers"), F.count_if(F.col("state") != "running").alias("down")
    )


def verdict(now: Column) -> Column:
    """The first verdict that applies, from metric and host columns."""
    quiet = F.unix_seconds("last_progress") < F.unix_seconds(now) - 300
    return (
        F.when((F.col("workers") > 0) & (F.col("down") > 0),
               F.when(F.col("down") >= F.col("workers"), "FLEET_DOWN").otherwise("WORKER_DEGRADED"))
        .when(F.col("host_state") == "unreachable", "HOST_UNREACHABLE")
        .when(F.col("backlog") == 0, "IDLE")
        .when((F.col("zero_yield_ratio") >= 0.5) | (F.col("recent_timeouts") >= 3), "PROXY_DEGRADED")
        .when(F.col("longest_running_sec") > 600, "WEDGED")
        .when((F.col("longest_running_sec") == 0) & quiet, "STALLED")
        .otherwise("HEALTHY")
    )


def action(verdict_: Column, streak: Column, since_restart: Column, since_refresh: Column, workers: Column,
           required: int = REQUIRED_TICKS) -> Column:
    """What the policy allows: an action, none, or suppressed with the reason."""
    want, cooldown = F, F
    for name, (act, minutes) in ACTIONS.items():
        want = want.when(verdict_ == name, act)
        cooldown = cooldown.when(verdict_ == name, minutes)
    want, cooldown = want.otherwise(F.lit(None)), cooldown.otherwise(F.lit(None))
    since = F.when(want == "restart", since_restart).otherwise(since_refresh)
    return (
        F.when(verdict_ == "FLEET_DOWN", "suppressed:entire fleet down; needs human attention")
        .when(verdict_ == "HOST_UNREACHABLE", "suppressed:host unreachable; needs human attention")
        .when(want.isNull(), "none")
        .when(workers == 0, "suppressed:no worker hosts configured")
        .when(streak < required, F.concat(
            F.lit("suppressed:"), verdict_, F.lit(" seen "), streak.cast("string"), F.lit(f"/{required} consecutive ticks")))
        .when(since < cooldown, F.concat(
            F.lit("suppressed:"), want, F.lit(" in cooldown ("), since.cast("string"), F.lit("m of "),
            cooldown.cast("string"), F.lit("m)")))
        .otherwise(want)
    )


def decide(ticks: DataFrame, key: str, now: Column, workers: Column, at: str = "checked_at", tie: str = "tick_id") -> DataFrame:
    """Action per fleet from its tick log: newest verdict, its streak, time since the last good action."""
    streaks = trailing_streak(ticks, [key], at, "verdict", tie)
    ok = F.coalesce("action_ok", F.lit(False))
    restart = minutes_since(ticks, [key], at, (F.col("action") == "restart") & ok, now).withColumnRenamed("minutes", "since_restart")
    refresh = minutes_since(ticks, [key], at, (F.col("action") == "proxy_refresh") & ok, now).withColumnRenamed("minutes", "since_refresh")
    joined = streaks.join(restart, key).join(refresh, key)
    return joined.withColumn("decision", action(
        F.col("verdict"), F.col("streak"), F.col("since_restart"), F.col("since_refresh"), workers))
