"""Queries over fleet health: metrics, verdicts, streaks, actions."""

from __future__ import annotations

from pyspark.sql import functions as F

from prospectra.catalog.registry import query
from prospectra.catalog.world import table, world
from prospectra.functions.reviews import as_time
from prospectra.operators import topk
from prospectra.plans import health as H
from prospectra.session import new_path
from prospectra.streaming.events import file_events
from prospectra.streaming.health import decide_stream

NOW = "2024-01-31 00:00:00"

_STREAK = """
    r AS (SELECT fleet, verdict, row_number() OVER (PARTITION BY fleet ORDER BY checked_at DESC, tick_id DESC) AS rn FROM ticks),
    t AS (SELECT * FROM r WHERE rn <= 10), c AS (SELECT fleet, verdict FROM r WHERE rn = 1),
    s AS (SELECT c.fleet, c.verdict, CAST(coalesce(MIN(t.rn) FILTER (WHERE t.verdict <> c.verdict), COUNT(*) + 1) - 1 AS INTEGER) AS streak FROM c JOIN t USING (fleet) GROUP BY 1, 2),
    m AS (SELECT fleet, coalesce(CAST(round(epoch(TIMESTAMP '2024-01-31' - MAX(checked_at) FILTER (WHERE action = 'restart' AND action_ok)) / 60) AS BIGINT), 99999) AS since_restart,
                 coalesce(CAST(round(epoch(TIMESTAMP '2024-01-31' - MAX(checked_at) FILTER (WHERE action = 'proxy_refresh' AND action_ok)) / 60) AS BIGINT), 99999) AS since_refresh FROM ticks GROUP BY 1)"""


@query("W02 W06", f"WITH {_STREAK} SELECT fleet, verdict, streak FROM s", ("ticks",))
def trailing_streaks(spark, sf):
    return topk.trailing_streak(world(spark, sf, "ticks"), ["fleet"], "checked_at", "verdict", "tick_id")


@query("W02", f"WITH {_STREAK}, w AS (SELECT fleet, CAST(coalesce(MIN(rn) FILTER (WHERE verdict <> 'WEDGED'), COUNT(*) + 1) - 1 AS INTEGER) AS streak FROM t GROUP BY 1) SELECT fleet, 'WEDGED' AS verdict, streak FROM w", ("ticks",))
def wedged_streaks(spark, sf):
    return topk.trailing_streak(world(spark, sf, "ticks"), ["fleet"], "checked_at", "verdict", "tick_id", F.lit("WEDGED"))


@query("W03", f"WITH {_STREAK} SELECT fleet, since_restart AS minutes FROM m", ("ticks",))
def minutes_since_restart(spark, sf):
    done = (F.col("action") == "restart") & F.col("action_ok")
    return topk.minutes_since(world(spark, sf, "ticks"), ["fleet"], "checked_at", done, as_time(NOW))


_DECISION = """CASE WHEN w IS NULL THEN 'none' WHEN streak < 3 THEN 'suppressed:' || verdict || ' seen ' || streak || '/3 consecutive ticks'
    WHEN since < cd THEN 'suppressed:' || w || ' in cooldown (' || since || 'm of ' || cd || 'm)' ELSE w END"""


def _decide_sql(where: str = "") -> str:
    return f"""WITH {_STREAK}, d AS (SELECT s.*, m.since_restart, m.since_refresh, CASE verdict WHEN 'PROXY_DEGRADED' THEN 'proxy_refresh' WHEN 'WEDGED' THEN 'restart' END AS w,
        CASE verdict WHEN 'PROXY_DEGRADED' THEN 30 ELSE 15 END AS cd, CASE verdict WHEN 'PROXY_DEGRADED' THEN since_refresh ELSE since_restart END AS since FROM s JOIN m USING (fleet))
        SELECT fleet, verdict, streak, {_DECISION} AS decision FROM d {where}"""


@query("D33 W02 W03", _decide_sql(), ("ticks",))
def fleet_actions(spark, sf):
    return H.decide(world(spark, sf, "ticks"), "fleet", as_time(NOW), F.lit(3)).select("fleet", "verdict", "streak", "decision")


@query("D32 A21", """
    SELECT user_id, CASE WHEN d > 0 AND d >= w THEN 'FLEET_DOWN' WHEN d > 0 THEN 'WORKER_DEGRADED' WHEN user_id % 17 = 0 THEN 'HOST_UNREACHABLE' WHEN backlog = 0 THEN 'IDLE'
             WHEN zero >= 0.5 OR timeouts >= 3 THEN 'PROXY_DEGRADED' WHEN running > 600 THEN 'WEDGED' WHEN running = 0 AND quiet THEN 'STALLED' ELSE 'HEALTHY' END AS verdict, backlog, zero AS zero_yield_ratio, running AS longest_running_sec
    FROM (SELECT user_id, CASE WHEN user_id % 13 = 0 THEN 3 WHEN user_id % 13 = 1 THEN 1 ELSE 0 END AS d, 3 AS w, COUNT(*) FILTER (WHERE event_type = 'click' AND value > 60) AS backlog,
                 COUNT(*) FILTER (WHERE event_type = 'error' AND value > 95 AND ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 20 MINUTE) AS timeouts,
                 coalesce(CAST(floor(epoch(TIMESTAMP '2024-01-30 12:00:00' - MIN(ts) FILTER (WHERE event_type = 'view' AND ts > TIMESTAMP '2024-01-30 11:00:00'))) AS BIGINT), 0) AS running,
                 MAX(ts) < TIMESTAMP '2024-01-30 11:55:00' AS quiet, COUNT(*) FILTER (WHERE rn <= 10 AND value < 40) / 10.0::DOUBLE AS zero
          FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE ts <= TIMESTAMP '2024-01-30 12:00:00') GROUP BY 1)
""")
def fleet_verdicts(spark, sf):
    """Queue metrics and verdict of every fleet, with events as its jobs and results."""
    now = as_time("2024-01-30 12:00:00")
    e = table(spark, sf, "events").withColumn("at", F.col("ts").cast("timestamp")).filter(F.col("at") <= now)
    kind = F.col("event_type")
    jobs = e.select(
        "user_id", F.when((kind == "click") & (F.col("value") > 60), "available").when((kind == "view") & (F.col("at") > as_time("2024-01-30 11:00:00")), "running")
        .when((kind == "error") & (F.col("value") > 95), "discarded").otherwise("completed").alias("state"),
        F.col("at").alias("scheduled_at"), F.col("at").alias("attempted_at"), F.col("at").alias("finalized_at"),
        F.lit("job timed out with no results").alias("errors"))
    results = e.select("user_id", F.col("event_id").alias("result_id"), F.col("at").alias("created_at"), F.when(F.col("value") < 40, 0).otherwise(5).alias("result_count"))
    probes = e.select("user_id").distinct().withColumn("host", F.explode(F.sequence(F.lit(0), F.lit(2)))).withColumn(
        "state", F.when((F.col("user_id") % 13 == 0) | ((F.col("user_id") % 13 == 1) & (F.col("host") == 0)), "exited").otherwise("running"))
    metrics = H.queue_metrics(jobs, results, now, "user_id").join(H.host_states(probes, "user_id"), "user_id") \
        .withColumn("host_state", F.when(F.col("user_id") % 17 == 0, "unreachable").otherwise("running"))
    return metrics.select("user_id", H.verdict(now).alias("verdict"), "backlog", "zero_yield_ratio", "longest_running_sec")


@query("ST10 D33", _decide_sql().replace("TIMESTAMP '2024-01-31'", "(SELECT MAX(checked_at) FROM ticks)"), ("ticks",))
def stream_fleet_actions(spark, sf):
    """The same decisions from a stream of ticks, which carries a small state per fleet."""
    ticks = file_events(spark, sf).select(
        F.col("event_id").alias("tick_id"), F.col("user_id").alias("fleet"), F.col("at").alias("checked_at"),
        F.element_at(F.array(*[F.lit(v) for v in ("HEALTHY", "WEDGED", "WEDGED", "PROXY_DEGRADED", "WEDGED", "IDLE")]),
                     (F.floor(F.col("event_id") / 200) % 6 + 1).cast("int")).alias("verdict"),
        F.when(F.col("event_type") == "click", "restart").when(F.col("event_type") == "view", "proxy_refresh").otherwise("none").alias("action"),
        (F.col("value") > 20).alias("action_ok"))
    log, state, out, mark = (new_path(spark, x) for x in ("ticks", "fleet-state", "decisions", "decisions-progress"))
    decide_stream(ticks, log, state, out, mark, "fleet", 3).awaitTermination()
    return spark.read.parquet(out).select("fleet", "verdict", "streak", "decision")
